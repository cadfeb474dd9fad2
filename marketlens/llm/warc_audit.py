"""Operator 8: Merkle fixity audit of WARC replicas.

Each record is hashed; the hashes of the records that start in one stretch of an archive's bytes make a node, FANOUT neighbouring nodes make one
of the next level, up to a root for the archive, and the archives' roots make the replica's root. Two replicas are compared from the
root down: only children of nodes that differ are looked at, so what is read beyond the roots grows with the damage.
A stretch holds a bounded number of records, whatever the size of an archive, as long as offsets differ. Records that share an offset (or have
none) may be any number: equal ones are counted before they are moved, and a stretch is first hashed by parts, dealt by the records' digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import read_table, written

STRETCH = 64 * 1024
FANOUT = 16
SLOTS = 4096
RECORD = ["archive", "offset", "length", "digest"]


def manifest(records: DataFrame) -> DataFrame:
    """``archive``, ``offset``, ``length`` and ``digest`` (SHA-256 in hex) of each record.

    ``records`` has archive (string), offset (long) and record (binary). A null record counts as empty. A null archive is one archive of its
    own, a null offset comes before all others; other columns are ignored. Repeated rows are repeated records.
    """
    data = F.coalesce(F.col("record"), F.lit(b""))
    return records.select(F.col("archive").cast("string").alias("archive"), F.col("offset").cast("long").alias("offset"),
                          F.octet_length(data).cast("long").alias("length"), F.sha2(data, 256).alias("digest"))


def _combined(*parts: str) -> Column:
    """SHA-256 of a group's rows in the order of their parts."""
    rows = F.array_sort(F.collect_list(F.struct(*parts)))
    return F.sha2(F.array_join(F.transform(rows, lambda r: F.concat_ws(":", *(F.coalesce(r[p].cast("string"), F.lit("-")) for p in parts))), ";"), 256)


def levels_of(*manifests: DataFrame) -> int:
    """Levels that a tree needs to end in one node for each archive of all these manifests."""
    ends = [m.agg(F.max("offset")).first()[0] or 0 for m in manifests]
    levels, reach = 1, STRETCH
    while reach <= max(ends):
        levels, reach = levels + 1, reach * FANOUT
    return levels


def _stretch() -> Column:
    return F.floor(F.coalesce(F.col("offset"), F.lit(0)) / STRETCH)


def dealt(leaves: DataFrame) -> DataFrame:
    """Different records with their ``copies``, the ``node`` they belong to and the ``part`` of it, one of SLOTS * SLOTS by the digest."""
    return leaves.groupBy(*RECORD).agg(F.count("*").alias("copies")).select(
        *RECORD, "copies", _stretch().alias("node"), F.pmod(F.crc32("digest"), F.lit(SLOTS * SLOTS)).alias("part"))


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes of each level from the lowest to the archives' roots: ``archive``, ``node`` (number of the stretch) and ``hash``.

    The lowest nodes are hashed in three steps: parts, groups of SLOTS parts, the stretch.
    """
    nodes = dealt(leaves).groupBy("archive", "node", "part").agg(_combined("offset", "length", "digest", "copies").alias("hash"))
    nodes = nodes.groupBy("archive", "node", F.floor(F.col("part") / SLOTS).alias("group")).agg(_combined("part", "hash").alias("hash"))
    nodes = nodes.groupBy("archive", "node").agg(_combined("group", "hash").alias("hash"))
    out = [nodes]
    for _ in range(levels - 1):
        nodes = nodes.groupBy("archive", F.floor(F.col("node") / FANOUT).alias("node")).agg(_combined("node", "hash").alias("hash"))
        out.append(nodes)
    return out


def replica_root(roots: DataFrame) -> str:
    """One hash for a replica: its archives' roots, first by slots of the name, then the slots."""
    slots = roots.groupBy(F.pmod(F.crc32(F.coalesce("archive", F.lit(""))), F.lit(SLOTS)).alias("slot")).agg(
        _combined("archive", "node", "hash").alias("hash"))
    return slots.agg(_combined("slot", "hash").alias("hash")).first()["hash"]


def compared_records(left: DataFrame, right: DataFrame) -> DataFrame:
    """The records under the stretches in which two manifests differ: RECORD, ``left_copies`` and ``right_copies``.

    Equal replicas give no rows, and no more than the roots is compared. The manifests are read several times, so pass written tables.
    """
    levels = levels_of(left, right)
    trees = tree(left, levels), tree(right, levels)
    differ = None
    if replica_root(trees[0][-1]) == replica_root(trees[1][-1]):
        left, right = left.limit(0), right.limit(0)
    else:
        for a, b in zip(reversed(trees[0]), reversed(trees[1]), strict=True):
            if differ is not None:
                a, b = (_below(x, differ, F.floor(F.col("node") / FANOUT)) for x in (a, b))
            key = ["archive", "node"]
            differ = written(_outer(a, b, key, ["hash"]).where("not (l_hash <=> r_hash)").select(*key), "warc-differ")
        left, right = (_below(m, differ, _stretch()) for m in (left, right))
    rows = left.select(*RECORD, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*RECORD, F.lit(0).alias("l"), F.lit(1).alias("r")))
    return rows.groupBy(*RECORD).agg(F.sum("l").alias("left_copies"), F.sum("r").alias("right_copies"))


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Places in which two manifests differ: ``archive``, ``offset``, ``status``, ``left_records`` and ``right_records`` (how many each has
    there), and of each side ``length`` and ``digest`` of a record that it has more often than the other (the smallest; null if none).

    ``status`` is "corrupt" where both have a record there but not the same, "missing" where only ``left`` has one, "extra" where only
    ``right`` has. Records repeated at an offset count with their copies; ``compared_records`` tells them apart.
    """
    of = lambda more, less: F.min(F.when(F.col(f"{more}_copies") > F.col(f"{less}_copies"), F.struct("length", "digest"))).alias(more)
    places = compared_records(left, right).groupBy("archive", "offset").agg(
        F.sum("left_copies").alias("left_records"), F.sum("right_copies").alias("right_records"), of("left", "right"), of("right", "left"))
    status = F.when(F.col("right_records") == 0, "missing").when(F.col("left_records") == 0, "extra").otherwise("corrupt")
    return places.where("left is not null or right is not null").select(
        "archive", "offset", status.alias("status"), "left_records", "right_records",
        *(F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("left", "right") for c in ("length", "digest")))


def _below(nodes: DataFrame, parents: DataFrame, parent: Column) -> DataFrame:
    """Rows under the given parents."""
    up = parents.select(F.col("archive").alias("_archive"), F.col("node").alias("_parent"))
    return nodes.join(up, F.col("archive").eqNullSafe(F.col("_archive")) & (parent == F.col("_parent")), "left_semi")


def _outer(a: DataFrame, b: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Full outer join as one aggregation: each side has a key once; null keys meet."""
    side = lambda d, mine, other: d.select(*key, *(F.col(v).alias(f"{mine}_{v}") for v in values),
                                           *(F.lit(None).cast(d.schema[v].dataType).alias(f"{other}_{v}") for v in values))
    return side(a, "l", "r").unionByName(side(b, "r", "l")).groupBy(*key).agg(
        *(F.first(c, ignorenulls=True).alias(c) for v in values for c in (f"l_{v}", f"r_{v}")))


PAGES_AN_ARCHIVE = 256


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as the records of WARC archives: ``page_id``, ``archive``, ``offset`` and ``record``, 256 page ids an archive, in their order."""
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.coalesce(F.col("url").cast("string"), F.lit(""))
    md5 = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), url))
    uuid = F.concat_ws("-", *(F.substring(md5, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), uuid, F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n")).cast("binary")
    archive = F.concat(F.lit("pages-"), F.coalesce(F.floor(F.col("page_id") / PAGES_AN_ARCHIVE).cast("string"), F.lit("none")))
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), archive.alias("archive"), record.alias("record"), url.alias("url"))
    before = Window.partitionBy("archive").orderBy("page_id", "url", "record").rowsBetween(Window.unboundedPreceding, -1)
    return sized.select("page_id", "archive", F.coalesce(F.sum(F.octet_length("record").cast("long")).over(before), F.lit(0)).alias("offset"), "record")


def second_replica(records: DataFrame) -> DataFrame:
    """A stand-in for a replica that has aged: some records are damaged in one byte, some are gone."""
    broken = F.concat(F.expr("substring(record, 1, 20)"), F.lit(b"\x00"), F.expr("substring(record, 22)"))
    return records.where(~F.coalesce(F.col("page_id") % 499 == 7, F.lit(False))).withColumn(
        "record", F.when(F.col("page_id") % 211 == 3, broken).otherwise(F.col("record")))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record with its place, digest and state in the second replica, as the audit of the two finds it."""
    records = page_records(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    first = written(manifest(records), "warc-first")
    second = written(manifest(second_replica(records)), "warc-second")
    found = audit(first, second).select("archive", "offset", "status")
    return first.join(found, ["archive", "offset"], "left").select(
        "archive", "offset", "length", "digest", F.coalesce("status", F.lit("ok")).alias("status"))


_RECORD = """
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:'
  || substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12) || '>'
  || chr(13) || chr(10) || 'WARC-Target-URI: ' || u || chr(13) || chr(10) || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10)
  || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(h)) || chr(13) || chr(10) || chr(13) || chr(10)
  || h || chr(13) || chr(10) || chr(13) || chr(10)
"""

OP8_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h, md5(concat_ws('|', CAST(page_id AS VARCHAR), coalesce(url, ''))) AS m FROM pages
), r AS (
  SELECT page_id, u, 'pages-' || coalesce(CAST(CAST(floor(page_id / {PAGES_AN_ARCHIVE}) AS BIGINT) AS VARCHAR), 'none') AS archive, encode({_RECORD}) AS record FROM p
), o AS (
  SELECT page_id, archive, octet_length(record) AS length, sha256(record) AS digest,
    coalesce(sum(octet_length(record)) OVER (PARTITION BY archive ORDER BY page_id NULLS FIRST, u, record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM r
)
SELECT archive, CAST(o AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, digest,
  CASE WHEN page_id % 499 = 7 THEN 'missing' WHEN page_id % 211 = 3 THEN 'corrupt' ELSE 'ok' END AS status
FROM o
"""

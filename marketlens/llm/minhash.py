"""Operator 4: near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Documents are lower-cased and cut at white space; shingles are five words in a row, weighted by their count in the document times
a smoothed inverse document frequency. The frequencies cover all documents and are kept by feature hashing: a fixed
number of buckets, so that what the tasks send and read does not grow with the corpus. (A shingle's bucket holds other
shingles too; seen as a share of all documents that floor is the same at every size.)

A sketch has one sample for each of ``BANDS * ROWS`` draws; two documents agree in a draw with a probability equal to their weighted
Jaccard similarity. Documents that agree in all rows of a band meet in a bucket. In a bucket all are compared with one centre first, the one that
meets most others, which joins a group of copies with one comparison a member; buckets that still hold several components get a
few more centres, against the other components. What is left is compared in blocks of bounded size,
each pair in the first band it shares and only across components, so no link that could join two groups is left out and no list of
pairs is made. Every link is verified by exact weighted Jaccard similarity. Texts with the same words are one node from the
start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.common import read_table, starts, text_slices, written
from marketlens.llm.components import connected_components

WORDS = 5
THRESHOLD = 0.8
# A pair at the threshold is missed with a probability of (1 - 0.8^3)^12, about 2 in 10,000.
BANDS, ROWS = 12, 3
# Share of the documents below which frequencies hardly differ in weight. Passages that a good part of all documents hold lose weight;
# the shingles of a text with many copies are not to lose so much that its near copies fall under the threshold.
SMOOTHING = 0.05
BUCKET_BITS = 21
SLAB = 1 << 14
SHINGLE_BITS = 44
SLICE_CHARS = 2_500_000
STAR_ROUNDS = 3
# Members that a group of the second comparison holds: a chunk against a slice.
CHUNK, SLICE = 128, 1024
# Parts that the shingles of a text are dealt to by their hash, for a bound on what two texts share.
PARTS = 256
# Rows of a band that a task of a join on bands takes; a band is split where it has more, and more than this share of the nodes. As a node has
# BANDS bands, at most BANDS / SPLIT_SHARE bands are split.
SPLIT_ROWS, SPLIT_SHARE = 512, 0.001

# First bytes of a node's key that tell its place among the marks of nodes in groups.
MARK_BYTES = 3

U64 = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _word_hashes(words: list[list[str]], n: int) -> np.ndarray:
    """Hash of each of the ``n`` words, end to end. Most words of a slice differ, so none is looked up."""
    try:
        return np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), U64, n)
    except UnicodeEncodeError:  # a lone surrogate
        return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in chain.from_iterable(words)), U64, n)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Distinct shingle hashes of each text (ascending, 44 bits), their counts, the texts' offsets, and a 128-bit key of the words.

    A text of one to four words has one shingle, all of its words; a text without words has none.
    """
    words = [t.lower().split() for t in texts]
    keys = [xxhash.xxh128_digest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    hashes = _word_hashes(words, int(n_words.sum()))
    edge = starts(n_words)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - WORDS + 1, 1), 0)
    first = np.repeat(edge[:-1] - starts(n_shingles)[:-1], n_shingles) + np.arange(int(n_shingles.sum()))
    # A polynomial of the words' hashes, mixed once; a text of fewer words has fewer terms.
    short = np.repeat(np.where(n_words < WORDS, n_words, WORDS), n_shingles) if (n_words < WORDS).any() else None
    padded = np.concatenate([hashes, np.zeros(WORDS, U64)])
    gram = np.zeros(len(first), U64)
    for k in range(WORDS):
        term = padded[first + k]
        gram = gram * U64(0x9E3779B97F4A7C15) + (term if short is None else np.where(k < short, term, U64(0)))
    gram = _mix(gram)
    gram >>= U64(64 - SHINGLE_BITS)
    out, counts, per_text = [], [], np.zeros(len(texts), np.int64)
    # Sorted as (text, shingle) in one word of 64 bits, so many texts at a time as fit in the upper bits.
    step, bounds = 1 << (64 - SHINGLE_BITS), starts(n_shingles)
    for a in range(0, len(texts), step):
        b = min(a + step, len(texts))
        own = np.repeat(np.arange(b - a, dtype=U64), n_shingles[a:b]) << U64(SHINGLE_BITS) | gram[bounds[a]:bounds[b]]
        own.sort()
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        at = np.flatnonzero(new)
        out.append(own[at] & U64((1 << SHINGLE_BITS) - 1))
        counts.append(np.diff(np.append(at, len(own))))
        per_text[a:b] = np.bincount((own[at] >> U64(SHINGLE_BITS)).astype(np.int64), minlength=b - a)
    return np.concatenate([*out, np.zeros(0, U64)]), np.concatenate([*counts, np.zeros(0, np.int64)]), starts(per_text), keys


def _bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle * U64(0x9E3779B97F4A7C15) >> U64(64 - BUCKET_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Number of documents by shingle bucket, and of documents with a shingle; all rows of ``docs`` count."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for _, texts in text_slices(batches, "text", SLICE_CHARS):
            hashes, _, offsets, _ = shingles(texts)
            sums += np.bincount(_bucket(hashes), minlength=len(sums))
            rows += int((np.diff(offsets) > 0).sum())
        if rows:
            slabs = sums.astype("<i8").reshape(-1, SLAB)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(slabs)), pa.int32()), pa.array([rows] * len(slabs), pa.int64()),
                                              pa.array([zlib.compress(_columns(s), 1) for s in slabs], pa.binary())],
                                             ["slab", "rows", "packed"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([_uncolumns(zlib.decompress(p)) for p in frame["packed"]], axis=0)
        return pd.DataFrame({"slab": frame["slab"].iloc[:1], "rows": int(frame["rows"].sum()), "packed": [zlib.compress(_columns(total), 1)]})

    kind = "slab int, rows long, packed binary"
    # 2^BUCKET_BITS counts come to the driver, whatever the number of documents.
    table = docs.select("text").mapInArrow(count, kind).groupBy("slab").applyInPandas(add, kind).toArrow().sort_by("slab")
    if not table.num_rows:
        return np.zeros(1 << BUCKET_BITS, np.int64), 0
    return (np.concatenate([_uncolumns(zlib.decompress(p)) for p in table.column("packed").to_pylist()]),
            int(table.column("rows")[0].as_py()))


def _columns(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _uncolumns(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def inverse_frequencies(frequencies: np.ndarray, rows: int) -> np.ndarray:
    """1 + ln((1 + documents) / (1 + frequency + SMOOTHING * documents)), as a share of documents alike at every size."""
    return np.maximum(1 + np.log((1 + rows) / (1 + frequencies + SMOOTHING * rows)), 0.1).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: for each draw a Gamma(2,1) r and c and a uniform b per shingle, by hash.

    A shingle of weight w takes part with t = floor(ln w / r + b) and the rank ln c - r (t - b + 1); the sample of a draw is the
    (shingle, t) with the least rank. The variables are looked up in tables of 2^16 quantiles.
    """

    def __init__(self, draws: int = BANDS * ROWS) -> None:
        rng = np.random.Generator(np.random.PCG64(20_240_501))
        self.r = (-np.log(rng.random(65536)) - np.log(rng.random(65536))).astype(np.float32)
        self.log_c = np.log(-np.log(rng.random(65536)) - np.log(rng.random(65536))).astype(np.float32)
        self.b = rng.random(65536).astype(np.float32)
        self.salts = (rng.integers(1, 2**63, draws).astype(U64) << U64(1)) | U64(1)

    def sketches(self, hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
        """Samples (texts x draws, uint32) of texts with shingles; 0 for a text without."""
        out = np.zeros((len(offsets) - 1, len(self.salts)), np.uint32)
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        if not len(full):
            return out
        log_w = np.log(weights).astype(np.float32)
        # Some texts at a time, so that the arrays stay in the processor's cache.
        cuts = [0]
        while cuts[-1] < len(full):
            nxt = int(np.searchsorted(offsets[full], offsets[full[cuts[-1]]] + piece))
            cuts.append(max(nxt, cuts[-1] + 1))
        mask = U64(0xFFFF)
        for a, b in zip(cuts, cuts[1:], strict=False):
            rows = full[a:b]
            lo, hi = offsets[rows[0]], offsets[rows[-1] + 1]
            h, lw, at = hashes[lo:hi], log_w[lo:hi], offsets[rows] - lo
            lengths = np.diff(np.append(at, hi - lo))
            x, y, z = (np.empty(hi - lo, U64) for _ in range(3))
            for j, salt in enumerate(self.salts):
                np.multiply(h, salt, out=x)
                np.right_shift(x, U64(32), out=y)
                x ^= y
                x *= U64(0xD6E8FEB86659FD93)
                np.right_shift(x, U64(29), out=y)
                x ^= y
                r = self.r[np.bitwise_and(x, mask, out=y).view(np.int64)]
                np.right_shift(x, U64(16), out=y)
                beta = self.b[np.bitwise_and(y, mask, out=y).view(np.int64)]
                np.right_shift(x, U64(32), out=z)
                rank = self.log_c[np.bitwise_and(z, mask, out=z).view(np.int64)]
                t = np.divide(np.float32(1), r)
                t *= lw
                t += beta
                np.floor(t, out=t)
                np.subtract(t, beta, out=beta)
                beta += np.float32(1)
                beta *= r
                rank -= beta
                # Only what is level with a text's least rank, far beyond the steps of the fixed point, can be its sample.
                least = np.maximum(np.minimum.reduceat(rank, at), np.float32(-95.9)) + np.float32(1e-3)
                near = np.flatnonzero(rank <= np.repeat(least, lengths))
                # Rank as fixed point over (-96, 32), then the sample's own 32 bits, which also settle ties.
                fixed = (np.maximum(rank[near], np.float32(-95.9)) * np.float32(1 << 24) + np.float32(96 << 24)).astype(np.int64).view(U64)
                sample = (x[near] + t[near].astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)) * U64(0xFF51AFD7ED558CCD) >> U64(32)
                out[rows, j] = np.minimum.reduceat(fixed << U64(32) | sample, np.searchsorted(near, at)) & U64(0xFFFFFFFF)
        return out


def sketch_documents(docs: DataFrame, idf) -> DataFrame:
    """``doc_id``, ``node`` (key of the words, null without words) and ``bands`` (a hash for each band) of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for rows, texts in text_slices(batches, "text", SLICE_CHARS):
            hashes, counts, offsets, keys = shingles(texts)
            sketch = sampler.sketches(hashes, counts * idf.value[_bucket(hashes)], offsets)
            bands = np.empty((len(texts), BANDS), np.int64)
            for k in range(BANDS):
                own = np.full(len(texts), k + 1, U64)
                for r in range(ROWS):
                    own = _mix(own * U64(0x9E3779B97F4A7C15) + sketch[:, k * ROWS + r].astype(U64))
                bands[:, k] = own.view(np.int64)
            some = offsets[1:] > offsets[:-1]
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array([k if s else None for k, s in zip(keys, some.tolist(), strict=True)], pa.binary()),
                pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * BANDS, bands.ravel())],
                ["doc_id", "node", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, node binary, bands array<long>")


def packed_shingles(docs: DataFrame) -> DataFrame:
    """``node`` and its shingles (6 bytes each, ascending, then 4 bytes of count each) for the rows of ``node`` and ``text`` whose text has
    the node's words; other rows are left out."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, "text", SLICE_CHARS):
            hashes, counts, offsets, keys = shingles(texts)
            nodes = rows.column("node").to_pylist()
            own = [i for i, (k, n) in enumerate(zip(keys, nodes, strict=True)) if k == n]
            packed = [hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + counts[a:b].astype("<u4").tobytes()
                      for a, b in zip(offsets[own].tolist(), offsets[1:][own].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in own], pa.binary()), pa.array(packed, pa.binary())], ["node", "packed"])

    return docs.select("node", "text").mapInArrow(run, "node binary, packed binary")


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 10
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8, 6 * n).reshape(n, 6)
    return wide.view(U64).ravel(), np.frombuffer(packed, "<u4", n, 6 * n).astype(np.int64)


def weighed(packed: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles (ascending), their TF-IDF weights, and the sum of these."""
    hashes, counts = _unpacked(packed)
    weights = idf[_bucket(hashes)].astype(np.float64) * counts
    return hashes, weights, float(weights.sum())


def weighted_jaccard(left: tuple[np.ndarray, np.ndarray, float], right: tuple[np.ndarray, np.ndarray, float]) -> float:
    """Sum of the smaller over sum of the larger weights of two ``weighed`` shingle sets."""
    (a, x, total_a), (b, y, total_b) = (left, right) if len(left[0]) <= len(right[0]) else (right, left)
    if not len(a):
        return 0.0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    same = b[at] == a
    shared = float(np.minimum(x[same], y[at[same]]).sum())
    return shared / (total_a + total_b - shared)


def similarities(pairs: DataFrame, packed: DataFrame, idf) -> DataFrame:
    """``node``, ``centre`` and their exact weighted Jaccard similarity ``sim``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, centre = None, None
        for batch in batches:
            sim = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                if y != last:  # the join leaves a centre's rows together
                    last, centre = y, weighed(y, idf.value)
                sim.append(weighted_jaccard(weighed(x, idf.value), centre))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("centre"), pa.array(sim, pa.float64())],
                                             ["node", "centre", "sim"])

    return (pairs.join(packed.withColumnRenamed("packed", "left"), "node")
            .join(packed.selectExpr("node as centre", "packed as right"), "centre")
            .select("node", "centre", "left", "right").mapInArrow(run, "node binary, centre binary, sim double"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest id of its group) and ``kept`` (the row that stands for its group) of every row of ``docs``.

    ``docs`` has doc_id and text; other columns are ignored. Groups are the connected components of the verified links. Texts
    without words (null, empty, white space) are in no group: their class is their own id and they are kept. A null id belongs
    to its text's group but stands for it only if no row of the group has an id; a class without ids is null. Rows
    with the same id and words are all marked alike; ``representatives`` keeps one of them.
    """
    sketches, classes = _classes(docs, threshold)
    return (sketches.select("doc_id", "node").join(classes, "node", "left")
            .select("doc_id", F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
            .withColumn("kept", F.col("class_id").eqNullSafe(F.col("doc_id"))))


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group of near-duplicates, and every row without words, with all columns of ``docs``.

    The row with the smallest id stands for its group (one without id only where the group has none). Decisions are taken by row: of rows that
    are equal in id and words the least in all columns stays, and another text under the id of a dropped one is not dropped with it. The columns of
    ``docs`` must be orderable, and none be named ``__node`` or ``__marked``.
    """
    sketches, classes = _classes(docs, threshold)
    heads = classes.where("node = head").selectExpr("node", "class_id")
    again = written(sketches.select("doc_id", "node").join(heads, "node").where("doc_id <=> class_id").groupBy("node").agg(F.count("*").alias("n"))
                    .where("n > 1").select("node"), "minhash-again")
    marks = docs.sparkSession.sparkContext.broadcast(group_marks(classes))
    keyed = _keyed(docs, marks)
    # What the marks show to be in no group stays as it is; the join moves the texts of the others only.
    alone = keyed.where("not __marked").select(*docs.columns)
    marked = keyed.where("__marked").join(classes.select(F.col("node").alias("__node"), "head", "class_id"), "__node", "left")
    own = F.col("doc_id").cast("long").eqNullSafe(F.col("class_id"))
    kept = marked.where(F.col("head").isNull() | ((F.col("head") == F.col("__node")) & own)).select("__node", *docs.columns)
    if again.isEmpty():
        return alone.unionByName(kept.select(*docs.columns))
    again = again.withColumnRenamed("node", "__node")
    one = kept.join(again, "__node", "left_semi").groupBy("__node").agg(F.min(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return alone.unionByName(kept.join(again, "__node", "left_anti").select(*docs.columns)).unionByName(one)


def group_marks(classes: DataFrame) -> np.ndarray:
    """Marks of the nodes of ``classes``: a set bit for each one's place, of 2^MARK_BITS. A node whose bit is not set is in no group; others
    may share the bit of one that is, which grows with the number of nodes and only makes the join larger."""
    # Spark's bitmaps number places from 1 on, and so do their buckets.
    place = F.expr(f"cast(conv(hex(substring(node, 1, {MARK_BYTES})), 16, 10) as long) + 1").alias("place")
    bitmaps = (classes.select(place).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    marks = np.zeros(1 << 8 * MARK_BYTES - 3, np.uint8)
    # At most one bit for each place comes to the driver, 2 MB in all, whatever the number of nodes.
    for bucket, bits in bitmaps.toLocalIterator():
        first = (bucket - 1) * len(bits)
        marks[first:first + len(bits)] = np.frombuffer(bits, np.uint8)
    return marks


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id`` and ``node`` (null without words), and for the nodes of groups of several rows ``node``, ``class_id`` (smallest id, null
    where the group has none) and ``head`` (the node that this id belongs to)."""
    spark = docs.sparkSession
    slim = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
    frequencies, rows = document_frequencies(slim)
    idf = spark.sparkContext.broadcast(inverse_frequencies(frequencies, rows))
    sketches = written(sketch_documents(slim, idf), "minhash-sketches")
    # Copies of a text have the same bands.
    nodes = written(sketches.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.count("*").alias("copies")), "minhash-nodes")
    members = written(_members(nodes), "minhash-members")
    # Who meets most others is nearest to the middle of a group of copies: it makes the best centre.
    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    members = written(members.drop("n").join(degrees, "node"), "minhash-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    texts = wanted.join(slim.where("doc_id is not null"), "doc_id").select("node", "text")
    no_id = wanted.where("doc_id is null").join(_without_id(slim), "node").select("node", "text")
    # An id may have several texts; only the one with the node's words is it. Words are compared and shingles made by one Python worker a task:
    # Spark keeps as many workers as ever ran at once, and deals later tasks to all of them, each with a memory of its own.
    packed = written(packed_shingles(texts.unionByName(no_id)), "minhash-shingles")

    centres = members.groupBy("band").agg(F.max_by("node", F.struct("degree", "node")).alias("centre"), F.max("parts").alias("parts"))
    links = _verified(_join_bands(members, centres).where("node != centre"), packed, idf, threshold)
    found = connected_components(links)
    mixed = _mixed(members, found)
    for _ in range(STAR_ROUNDS - 1):
        if mixed.isEmpty():  # no band holds two components: nothing is left to compare
            break
        centres = mixed.where("component != main").groupBy("band").agg(
            F.max_by(F.struct("node", "component"), F.struct("degree", "node")).alias("c"), F.max("parts").alias("parts"))
        centres = centres.selectExpr("band", "parts", "c.node as centre", "c.component as own")
        more = _verified(_join_bands(mixed, centres).where("component != own"), packed, idf, threshold)
        found = connected_components(found.selectExpr("node as a", "component as b").unionByName(more))
        mixed = _mixed(members, found)
    if not mixed.isEmpty():
        across = written(_links_across(mixed, nodes.select("node", "bands"), packed, idf, threshold), "minhash-across")
        found = connected_components(found.selectExpr("node as a", "component as b").unionByName(across))
    # Classes of the nodes that stand for several rows; all other rows are their own class.
    grouped = nodes.join(found, "node", "left").selectExpr("node", "coalesce(component, node) as component", "doc_id", "copies")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("first")
    of_component = written(grouped.groupBy("component").agg(first, F.sum("copies").alias("size")).where("size > 1")
                           .selectExpr("component", "first.doc_id as class_id", "first.node as head"), "minhash-classes")
    return sketches, written(grouped.select("node", "component").join(of_component, "component").select("node", "class_id", "head"), "minhash-of")


def _members(nodes: DataFrame) -> DataFrame:
    """``band``, ``node`` and the band's size ``n`` for the bands of two nodes or more, with the ``parts`` that a band is split into and the part
    (``salt``) of this row."""
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "minhash-bands")
    split = F.col("n") > max(SPLIT_ROWS, int(nodes.count() * SPLIT_SHARE))
    shared = shared.withColumn("parts", F.when(split, F.ceil(F.col("n") / SPLIT_ROWS)).otherwise(1))
    # A list of BANDS / SPLIT_SHARE rows at most, whatever the number of nodes.
    hot = shared.where("parts > 1").selectExpr("band", "parts as own")
    salted = banded.join(F.broadcast(hot), "band", "left").select("node", "band", F.coalesce(F.pmod(F.xxhash64("node"), "own"), F.lit(0).cast("long")).alias("salt"))
    return _join_bands(salted, shared)


def _join_bands(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """Rows of ``band`` and ``salt`` with the row of their band, which is repeated for each of the band's ``parts``."""
    each = bands.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return rows.drop("parts").join(each, ["band", "salt"])


def _verified(pairs: DataFrame, packed: DataFrame, idf, threshold: float) -> DataFrame:
    """Links ``a`` - ``b`` among pairs of ``node`` and ``centre``, by exact similarity."""
    alike = similarities(pairs.select("node", "centre").distinct(), packed, idf).where(F.col("sim") >= threshold)
    return written(alike.selectExpr("node as a", "centre as b"), "minhash-links")


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the bands that hold several components, with their component and the band's largest one (``main``), its size ``most`` and
    the band's size ``n``."""
    labelled = written(members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "minhash-labelled")
    sizes = labelled.groupBy("band", "component").agg(F.count("*").alias("n"), F.max("parts").alias("parts"))
    bands = sizes.groupBy("band").agg(F.count("*").alias("components"), F.sum("n").alias("n"), F.max("n").alias("most"), F.max("parts").alias("parts"),
                                      F.max_by("component", F.struct("n", "component")).alias("main")).where("components > 1")
    return written(_join_bands(labelled, bands.drop("components")), "minhash-mixed")


def _links_across(mixed: DataFrame, bands: DataFrame, packed: DataFrame, idf, threshold: float) -> DataFrame:
    """Links ``a`` - ``b`` between nodes of different components that share a band; one for each two components of a block.

    In a bucket, the members outside its largest component are cut into chunks, all its members into slices; a group is a chunk and a slice.
    """
    inside = mixed.select("band", "node", "component", (F.col("component") != F.col("main")).alias("outer"),
                          F.ceil((F.col("n") - F.col("most")) / CHUNK).alias("chunks"), F.ceil(F.col("n") / SLICE).alias("slices"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("node", "band"), F.col(n))
    asking = inside.where("outer").select("band", one("chunks").alias("chunk"), every("slices").alias("slice"), "node", "component", "outer", F.lit(True).alias("asks"))
    asked = inside.select("band", every("chunks").alias("chunk"), one("slices").alias("slice"), "node", "component", "outer", F.lit(False).alias("asks"))
    rows = asking.unionByName(asked).join(bands, "node").join(packed, "node")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["band", "chunk", "slice"]):
            links = block_links(table, idf.value, threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in links], pa.binary()) for i in (0, 1)], ["a", "b"])

    # Most groups have two or three rows: they go to Python many at a time.
    return (rows.repartition("band", "chunk", "slice").sortWithinPartitions("band", "chunk", "slice")
            .select("band", "chunk", "slice", "node", "component", "outer", "asks", "bands", "packed").mapInArrow(compare, "a binary, b binary"))


def _whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, which lie together in the order of the batches; groups may go over several batches."""
    held: list[pa.Table] = []  # of the group that the last batch ended in
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rows = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((rows[:, 1:] != rows[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        if held and any(held[0].column(k)[0].as_py() != own for k, own in zip(keys, rows[:, 0].tolist(), strict=True)):
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            held.append(table.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)


def block_links(rows: pa.Table, idf: np.ndarray, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links between the members of a block that ask and those asked; one for each two components.

    Shingles of two texts that are the same fall in the same of ``PARTS`` parts: the sum over the parts of the smaller weights bounds what the texts
    share, and only pairs that can reach the threshold by it are compared exactly.
    """
    names = rows.column("node").to_pylist()
    in_order = {k: i for i, k in enumerate(sorted(set(names)))}
    number = np.array([in_order[k] for k in names])
    of_component: dict = {}
    component = np.array([of_component.setdefault(k, len(of_component)) for k in rows.column("component").to_pylist()])
    own = np.array(rows.column("bands").to_pylist(), np.int64)
    at = int(np.flatnonzero(own[0] == rows.column("band")[0].as_py())[0])
    asks, outer = (rows.column(k).to_numpy() for k in ("asks", "outer"))
    data = [weighed(p, idf) for p in rows.column("packed").to_pylist()]
    weights = np.array([w for _, _, w in data])
    by_part = np.stack([np.bincount((h & U64(PARTS - 1)).astype(np.int64), w, PARTS) for h, w, _ in data])
    joined = np.arange(len(of_component))  # components that links of this block have joined
    q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
    links = []
    for i in q.tolist():
        some = m[(joined[component[m]] != joined[component[i]]) & ~(outer[m] & (number[m] < number[i]))
                 & (np.minimum(weights[m], weights[i]) >= threshold * np.maximum(weights[m], weights[i]))]
        some = some[(own[some, :at] != own[i, :at]).all(axis=1)]
        most = np.minimum(by_part[some], by_part[i]).sum(axis=1)
        # A little less than the threshold, as both sums are rounded.
        some = some[most * (1 + threshold) >= threshold * (weights[some] + weights[i]) * (1 - 1e-9)]
        for j in some.tolist():
            x, y = joined[component[i]], joined[component[j]]
            if x != y and weighted_jaccard(data[i], data[j]) >= threshold:
                links.append((names[i], names[j]))
                joined[joined == max(x, y)] = min(x, y)
    return links


def _keyed(docs: DataFrame, marks=None) -> DataFrame:
    """Rows with ``__node``, the key of their words, null without words; with ``group_marks`` (broadcast) also ``__marked``, false for
    rows without words or in no group."""
    place, names = docs.columns.index("text"), [*docs.columns, "__node", *(["__marked"] if marks else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, place, SLICE_CHARS):
            keys = [xxhash.xxh128_digest(" ".join(w).encode("utf-8", "surrogatepass")) if (w := t.lower().split()) else None for t in texts]
            more = [pa.array([k is not None and is_marked(marks.value, k) for k in keys], pa.bool_())] if marks else []
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys, pa.binary()), *more], names)

    fields = [T.StructField("__node", T.BinaryType()), *([T.StructField("__marked", T.BooleanType())] if marks else [])]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def is_marked(marks: np.ndarray, node: bytes) -> bool:
    place = int.from_bytes(node[:MARK_BYTES], "big")
    return bool(marks[place >> 3] >> (place & 7) & 1)


def _without_id(slim: DataFrame) -> DataFrame:
    """A text for each node among the rows without id."""
    return _keyed(slim.where("doc_id is null")).groupBy(F.col("__node").alias("node")).agg(F.first("text").alias("text"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles, weighted Jaccard similarity of 0.8 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))

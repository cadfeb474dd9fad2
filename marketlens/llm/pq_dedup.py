"""Operator 9: near-duplicate vectors by product quantisation.

Unit vectors fall into coarse lists (nearest centroid); in a list they are held by codes of their residual, one of 256 codewords for
each subspace. The index is fitted on a bounded sample; every vector is indexed and every one asks. A vector
probes the lists of the PROBES nearest centroids, so the work grows with the vectors and not with their pairs; a pair is found if either
end probes the other's list. With ``probes=None`` it probes all lists that could hold a neighbour, those whose border with its own list is
within the linking distance, and no link is missed. In a list, distances
come from tables of the query's residual to the codewords. As each code's own error is kept, a candidate is
passed over only if the triangle inequality rules it out; the rest are compared by exact cosine.

Equal vectors are one node from the start. Lists are cut into blocks of bounded size and their askers into chunks, so a hot list becomes
many groups. A group returns a row for each linked node (its number of links and one node it hangs together with), not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import read_table, written
from marketlens.llm.components import connected_components
from marketlens.llm.vectors import by_dimension, sound

COSINE = 0.95
SAMPLE_ROWS, SAMPLE_A_LIST = 20_000, 16  # the sample has the larger of the first number and the second for each list: 65,536 rows at most
LIST_ROWS = 1024
LISTS = (8, 4096)  # least and most
PROBES = 8
SUBSPACES, CODEWORDS = 8, 256
BLOCK, CHUNK = 2048, 8192
SLACK = 1e-6


def _kmeans(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids (at most k of them, one for each distinct point if there are fewer)."""
    centres = np.unique(points[rng.permutation(len(points))[: 4 * k]], axis=0)
    centres = centres[rng.permutation(len(centres))[:k]]
    for _ in range(rounds):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    return np.maximum((points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T, 0)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(points[a:a + 4096], centres).argmin(axis=1) for a in range(0, len(points), 4096)])


class Index:
    """Centroids and codewords for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.centres = _kmeans(sample, lists, 10, rng)
        gaps = np.sqrt(_distances(self.centres, self.centres))
        self.gaps = np.where(gaps > 0, gaps, np.inf)
        residual = sample - self.centres[_nearest(sample, self.centres)]
        self.cuts = np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int)
        self.words = [_kmeans(residual[:, a:b], CODEWORDS, 6, rng) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def assign(self, unit: np.ndarray, reach: float, probes: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """List, codes, error of the code, and the lists to probe: the nearest ones, or all within reach that do not come before its own."""
        square = _distances(unit, self.centres)
        own = square.argmin(axis=1)
        at = np.arange(len(unit))
        if probes is None:
            margin = (square - square[at, own][:, None]) / (2 * self.gaps[own])
            margin[at, own] = 0
            wanted = [np.flatnonzero(w) for w in (margin <= reach + SLACK) & (np.arange(len(self.centres)) >= own[:, None])]
        else:
            square[at, own] = -1  # its own list comes first, whatever ties there are
            k = min(probes, len(self.centres))
            wanted = list(np.argpartition(square, k - 1, axis=1)[:, :k])
        residual = unit - self.centres[own]
        codes = np.stack([_nearest(residual[:, a:b], w) for a, b, w in zip(self.cuts, self.cuts[1:], self.words, strict=False)], axis=1)
        decoded = np.concatenate([w[c] for w, c in zip(self.words, codes.T, strict=True)], axis=1)
        error = np.linalg.norm(residual - decoded, axis=1)
        return own, codes.astype(np.uint8), error, wanted

    def table_distances(self, query: np.ndarray, list_no: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances (members x queries) of queries to coded members of a list, from tables of each query's residual to the codewords."""
        residual = query - self.centres[list_no]
        total = np.zeros((len(codes), len(query)), np.float32)
        part = np.empty_like(total)
        for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            # A row of the table for each codeword: a member copies its codeword's row.
            table = np.ascontiguousarray(_distances(self.words[k], residual[:, a:b]), np.float32)
            total += np.take(table, codes[:, k], axis=0, out=part, mode="clip")
        return total


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(rows, v / np.linalg.norm(v, axis=1, keepdims=True)) for rows, v in by_dimension(column)]


def _keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` and ``node``, a key of the vector's bytes; null for vectors that link with nothing."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            keys: list[bytes | None] = [None] * batch.num_rows
            for rows, v in by_dimension(column):
                norms = np.linalg.norm(v, axis=1)
                for r, x, n in zip(rows.tolist(), v + 0.0, norms.tolist(), strict=True):
                    if 0 < n < np.inf:
                        keys[r] = xxhash.xxh128_digest(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), column, pa.array(keys, pa.binary())],
                                             ["vec_id", "embedding", "node"])

    return vectors.mapInArrow(run, "vec_id long, embedding array<double>, node binary")


def _local_links(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node it hangs together with by the links a - b."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def linked_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                   sample_rows: int = SAMPLE_ROWS, probes: int | None = PROBES) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``; with ``probes=None`` no link is missed.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing and are their own component; vectors
    of different lengths do not link. Equal rows are linked like any others. A null id takes part, but is never a component's
    smallest id; a component without ids is null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    whole = _keyed(slim.withColumn("embedding", F.when(sound("embedding"), F.col("embedding"))))
    keyed = written(whole, "pq-vectors")
    nodes = written(keyed.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "pq-nodes")
    count = nodes.count()
    lists = min(max(count // LIST_ROWS, LISTS[0]), LISTS[1])
    # About so many rows: 65,536 at most by default.
    share = int(2**32 * min(1.0, max(sample_rows, SAMPLE_A_LIST * lists) / max(count, 1)))
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(2**32)) < share).select("embedding").toArrow().combine_chunks()
    parts = _units(sample.column("embedding").combine_chunks()) if sample.num_rows else []
    model = spark.sparkContext.broadcast({v.shape[1]: Index(v, min(lists, max(1, len(v) // 8))) for _, v in parts})

    def index_of(d: int) -> Index:
        # A dimension that the sample has not seen gets one list around the origin.
        return model.value[d] if d in model.value else Index(np.zeros((1, d)), 1)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, unit in _units(batch.column("embedding")):
                d = unit.shape[1]
                own, codes, error, wanted = index_of(d).assign(unit, reach, probes)
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").take(pa.array(rows)), batch.column("copies").take(pa.array(rows)),
                    pa.array([u.tobytes() for u in unit], pa.binary()), pa.array([d] * len(rows), pa.int32()), pa.array(own, pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(wanted, pa.list_(pa.int32()))],
                    ["node", "copies", "unit", "dim", "list", "codes", "error", "probes"])

    placed = written(nodes.select("node", "copies", "embedding").mapInArrow(
        assign, "node binary, copies long, unit binary, dim int, list int, codes binary, error double, probes array<int>"), "pq-index")
    asking = placed.withColumn("probe", F.explode("probes"))
    # A row a list: how many blocks its members make, and how many chunks those who ask it.
    cut = (placed.groupBy("dim", "list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
           .join(asking.groupBy("dim", F.col("probe").alias("list")).agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), ["dim", "list"]))
    cut = written(cut, "pq-cut")
    spread = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    members = (placed.join(cut, ["dim", "list"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
               .select("dim", "list", spread("block", "blocks").alias("block"), "chunk", "node", "copies", "unit", "codes", "error",
                       F.lit(None).cast("int").alias("home"), "probes"))
    asked = (asking.select("dim", F.col("probe").alias("list"), F.col("list").alias("home"), "node", "copies", "unit").join(cut, ["dim", "list"])
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("dim", "list", "block", spread("chunk", "chunks").alias("chunk"), "node", "copies", "unit",
                     F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), "home",
                     F.lit(None).cast("array<int>").alias("probes")))

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        d, list_no = int(frame["dim"].iloc[0]), int(frame["list"].iloc[0])
        index = index_of(d)
        member = frame["home"].isna().to_numpy()
        names, number = np.unique(frame["node"].to_numpy(object), return_inverse=True)
        copies = frame["copies"].to_numpy(np.int64)
        units = np.frombuffer(b"".join(frame["unit"]), np.float64).reshape(-1, d)
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        codes = np.frombuffer(b"".join(frame["codes"].iloc[m]), np.uint8).reshape(len(m), -1)
        own_lists = frame["probes"].iloc[m].tolist()
        asks = np.full((len(m), max(map(len, own_lists), default=0)), -1)  # the lists that each member asks itself
        for k, own in enumerate(own_lists):
            asks[k, :len(own)] = own
        home = frame["home"].fillna(-1).to_numpy(np.int64)
        within = ((reach + 1e-4 + frame["error"].to_numpy(np.float64)[m]) ** 2).astype(np.float32)[:, None]
        links = np.zeros(len(names), np.int64)
        a, b = [], []
        for s in range(0, len(q) if len(m) else 0, 512):
            own = q[s:s + 512]
            j, i = np.nonzero(index.table_distances(units[own], list_no, codes) <= within)
            # A pair is met twice in a list that both are of, and where both probe the other's list: then from the lower one.
            asker = home[own[i]]
            once = np.where(asker == list_no, number[own[i]] < number[m[j]], (asker < list_no) | ~(asks[j] == asker[:, None]).any(axis=1))
            i, j = own[i[once]], m[j[once]]
            hit = np.einsum("nd,nd->n", units[i], units[j]) >= cosine
            a.append(i[hit])
            b.append(j[hit])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
        np.add.at(links, number[a], copies[b])
        np.add.at(links, number[b], copies[a])
        low = _local_links(number[a], number[b], len(names))
        some = np.flatnonzero(links)
        return pd.DataFrame({"node": names[some], "mate": names[low[some]], "links": links[some]})

    found = written(members.unionByName(asked).groupBy("dim", "list", "block", "chunk").applyInPandas(
        match, "node binary, mate binary, links long"), "pq-links")
    groups = connected_components(found.selectExpr("node as a", "mate as b"))
    counted = nodes.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(groups, "node", "left").selectExpr(
        "node", "vec_id", "coalesce(component, node) as component", "coalesce(links, 0) + copies - 1 as n_links")
    lowest = written(counted.groupBy("component").agg(F.min("vec_id").alias("component_id")), "pq-components")
    result = written(counted.join(lowest, "component").select("node", "n_links", "component_id"), "pq-classes")
    return (keyed.select("vec_id", "node").join(result, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op9_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all vectors at a cosine of 0.95 or more."""
    return linked_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))

"""Operator 1: exact top-k search by inner product, pruned by segment statistics.

Vectors are cut into segments; the mean and deviation of each segment bound the distance of two vectors from below
(Cauchy-Schwarz within a segment), and as both norms are known, their inner product from above. A coarse cut is tried first, a
finer one for what it leaves, and only the survivors' products are computed. A candidate survives as long as its bound reaches the
query's k-th best score so far, so results are exact, ties included.

Queries come in blocks of bounded size; each block is broadcast and searched by every task through its own share of the candidates. A
task returns k rows a query, which one aggregation merges.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import read_table
from marketlens.llm.vectors import by_dimension, sound
from marketlens.session import scratch_path

SEGMENTS = (4, 16)
BLOCK_QUERIES = 2048
CHUNK = 1024
# Where more than this share of the pairs survives, whole products are cheaper than picked ones.
DENSE = 0.2


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each vector's segments, scaled so that the bound on the inner product is their inner product."""
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    length = np.diff(edges)
    mean = np.add.reduceat(vectors, edges[:-1], axis=1) / length
    square = np.add.reduceat((vectors - np.repeat(mean, length, axis=1)) ** 2, edges[:-1], axis=1) / length
    return np.concatenate([mean * np.sqrt(length), np.sqrt(square * length)], axis=1)


class TopK:
    """Best ``k`` candidates of each query so far, for queries of one dimension with whole-number components."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = np.linalg.norm(queries, axis=1)
        self.stats = [statistics(queries, s) for s in SEGMENTS]
        self.best = np.zeros((0, 3), object)  # query, score, candidate
        self.q, self.score, self.cand = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for a in range(0, len(ids), CHUNK):
            self._add(ids[a:a + CHUNK], vectors[a:a + CHUNK])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        # Room for the rounding of the bounds, so that they stay bounds.
        need = self.least[:, None] - 1e-9 * self.norms[:, None] * norms - 0.5
        alive = self.ids[:, None] != ids
        for own, segments in zip(self.stats, SEGMENTS, strict=True):
            theirs = statistics(vectors, segments)
            if alive.mean() > DENSE:
                alive &= own @ theirs.T >= need
            else:
                i, j = np.nonzero(alive)
                alive[i, j] = np.einsum("nd,nd->n", own[i], theirs[j]) >= need[i, j]
        i, j = np.nonzero(alive)
        if not len(i):
            return
        if float(self.norms.max() * norms.max()) >= 2.0**53:  # beyond what doubles hold exactly
            big = 2**63 - 1
            score = np.array([max(-big - 1, min(big, sum(int(x) * int(y) for x, y in zip(self.queries[a], vectors[b], strict=True))))
                              for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
        elif len(i) > DENSE * alive.size:
            score = (self.queries @ vectors.T)[i, j].astype(np.int64)
        else:
            score = np.einsum("nd,nd->n", self.queries[i], vectors[j]).astype(np.int64)
        keep = score >= self.least[i]
        q = np.concatenate([self.q, i[keep]])
        score = np.concatenate([self.score, score[keep]])
        cand = np.concatenate([self.cand, ids[j[keep]]])
        order = np.lexsort((cand, -score, q))
        q, score, cand = q[order], score[order], cand[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        rank = np.arange(len(q)) - first[q]
        top = rank < self.k
        self.q, self.score, self.cand = q[top], score[top], cand[top]
        last = rank[top] == self.k - 1
        self.least[self.q[last]] = self.score[last]


def _whole(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """floor(256 x) of each component."""
    return [(rows, np.floor(v * 256)) for rows, v in by_dimension(column)]


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best candidates of each query.

    ``is_query`` is a condition on the rows of ``vectors``. Components count as floor(256 x), scores as whole numbers (held at the
    bounds of a long). Ties go to the smaller id. Candidates are all rows but those with the query's own id. Rows with a null id, and vectors
    that are null, empty or hold null or non-finite components, take no part; vectors of different lengths are not compared. Query rows that are
    equal are answered once, equal candidates each count. Other columns are ignored.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & sound("embedding"))
    queries = slim.where("asks").select("vec_id", "embedding").distinct()
    blocks = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    path = scratch_path(spark, "top-k")
    found = "query_id long, vec_id long, score long"

    for block in range(blocks):
        # About BLOCK_QUERIES rows.
        table = queries.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)) == block).toArrow().combine_chunks()
        ids = np.asarray(table.column("vec_id").combine_chunks() if table.num_rows else pa.array([], pa.int64()))
        shared = spark.sparkContext.broadcast([(ids[rows], q) for rows, q in _whole(table.column("embedding").combine_chunks())]
                                              if table.num_rows else [])

        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = {q.shape[1]: TopK(i, q, k) for i, q in shared.value}  # noqa: B023 - used at once below
            for batch in batches:
                ids = np.asarray(batch.column("vec_id"))
                for rows, v in _whole(batch.column("embedding")):
                    if v.shape[1] in own:
                        own[v.shape[1]].add(ids[rows], v)
            for best in own.values():
                yield pa.RecordBatch.from_arrays([pa.array(best.ids[best.q]), pa.array(best.cand), pa.array(best.score)],
                                                 ["query_id", "vec_id", "score"])

        slim.select("vec_id", "embedding").mapInArrow(search, found).write.mode("append").parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spark.read.schema(found).parquet(path).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for each vector whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 5
"""

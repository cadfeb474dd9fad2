"""Operator 10: best-fit packing of tokenised documents under several capacities.

A sequence has a residual capacity in tokens, in documents and in attention cost (the sum of squared piece lengths). Pieces
come largest first; each goes to the open sequence with room in every capacity that the rule prefers: the smallest
weighted norm of what would be left ("norm"), or the best aligned residual by weighted dot-product ("dot"). A new sequence
opens only when none has room. Spark deals the pieces evenly to groups of bounded size, which are packed independently.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlens.llm.common import library_chunks, read_table, text_slices, written

MAX_TOKENS = 4096
# Pieces that one task packs; more pieces make more groups. The loss against one large group is under one sequence a group.
GROUP_PIECES = 24_576

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer_file: str, end_id: int = 1, max_tokens: int = MAX_TOKENS,
                     with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Documents as pieces of at most ``max_tokens`` ids, the end id included; only longer documents are cut.

    A null text counts as empty: one piece that holds the end id. Rows are kept one for one, null and repeated ids too.
    ``with_ids`` adds the ids of each piece; ``added_tokens`` as in ``library_chunks``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_chunks(tokenizer_file, byte_level=False, added_tokens=added_tokens)
        for rows, texts in text_slices(batches):
            ids, offsets = encoder(texts)
            ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            edges = offsets + np.arange(len(offsets))
            out: list[tuple] = []
            for doc_id, a, b in zip(rows.column(0).to_pylist(), edges.tolist(), edges[1:].tolist(), strict=False):
                out += [(doc_id, k, s - a, min(max_tokens, b - s), zlib.crc32(ids[s:min(s + max_tokens, b)].tobytes()), s)
                        for k, s in enumerate(range(a, b, max_tokens))]
            cols = list(zip(*out, strict=True))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([ids[s:s + n].astype(np.int32) for s, n in zip(cols[5], cols[3], strict=True)], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return (docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text")
            .mapInArrow(run, PIECES + ", ids array<int>" * with_ids))


def best_fit(demands: np.ndarray, capacities: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """Number of the sequence of each item; ``demands`` is items x resources, each row at most ``capacities``.

    Items go in descending order of their largest weighted demand (ties: all demands, then position); ties between sequences go to
    the oldest one.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule must be 'norm' or 'dot', not {rule!r}")
    if (demands > capacities).any():
        raise ValueError("an item exceeds a capacity")
    n = len(demands)
    relative = demands / capacities
    order = np.lexsort((np.arange(n), *(-demands.T[::-1]), -(relative * weights).max(axis=1)))
    smallest = demands.min(axis=0) if n else capacities
    left = np.empty((demands.shape[1], max(n, 1)))  # residuals of the open sequences, resource by resource
    number = np.empty(max(n, 1), np.int64)
    open_, made = 0, 0
    out = np.empty(n, np.int64)
    for i in order.tolist():
        need = demands[i]
        room = left[0, :open_] >= need[0]
        for k in range(1, len(need)):
            room &= left[k, :open_] >= need[k]
        at = np.flatnonzero(room)
        if len(at):
            rest = left[:, at]
            if rule == "norm":
                score = sum(weights[k] * ((rest[k] - need[k]) / capacities[k]) ** 2 for k in range(len(need)))
            else:
                share = rest / capacities[:, None]
                score = -((weights * relative[i]) @ share) / np.sqrt((weights[:, None] * share ** 2).sum(axis=0) + 1e-300)
            b = int(at[np.argmin(score)])
        else:
            b, open_, made = open_, open_ + 1, made + 1
            left[:, b], number[b] = capacities, made - 1
        left[:, b] -= need
        out[i] = number[b]
        if (left[:, b] < smallest).any():  # no item can follow: the sequence is closed, its place goes to the next one
            left[:, b:open_ - 1], number[b:open_ - 1] = left[:, b + 1:open_].copy(), number[b + 1:open_].copy()
            open_ -= 1
    return out


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_documents: int | None = None,
         max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm",
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a column ``length``) with ``sequence_id`` and ``offset`` (the place in the sequence, gapless from 0).

    Unset capacities never bind: as many documents as tokens, and the square of the tokens as attention cost; what is left of them still
    counts in the choice between sequences with room. A piece longer
    than ``max_tokens`` or costlier than ``max_attention`` raises an error; a null or negative length too. Other columns pass
    through. ``pieces`` is read twice (once to count), so pass a written table.
    """
    capacities = np.array([max_tokens, max_documents or max_tokens, max_attention or max_tokens**2], np.float64)
    groups = max(1, math.ceil(pieces.count() / group_pieces))

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [f for f in frames if len(f)]
        if not own:
            return
        frame = pd.concat(own, ignore_index=True)
        length = frame["length"].to_numpy(np.float64)
        if not (length >= 0).all():
            raise ValueError("a piece has no length")
        sequence = best_fit(np.stack([length, np.ones(len(length)), length**2], axis=1), capacities, np.array(weights), rule)
        frame = frame.assign(sequence_id=sequence + (np.int64(TaskContext.get().partitionId()) << 32))
        frame = frame.sort_values("sequence_id", kind="stable")
        frame["offset"] = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
        yield frame

    schema = T.StructType([f for f in pieces.schema if f.name not in ("sequence_id", "offset")]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    dealt = pieces.drop("sequence_id", "offset").repartition(groups)
    return dealt.mapInPandas(run, schema)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pack(written(tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True), "op10-pieces"))

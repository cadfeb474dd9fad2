"""Operator 12: periodic runs of words by block convolution with exact integer number-theoretic transforms.

At each dyadic scale B = 1, 2, 4, ... the words are cut into blocks of B. A run with a period from B to 2B - 1 that is four periods long
holds a whole block and its copy one period on. So each block is held against the window of 2B words behind it: the sum of squared
differences of word values at every distance is exact modulo a prime (a transform of 2B values), and 0 where the block occurs
again. Such distances are seeds: the words themselves are compared to both sides until the period breaks.

Two rules leave out blocks that cannot seed a new run: a block holding a word that does not occur again within 2B - 1 words, and a block
that with its window lies inside a run already found at a smaller scale (by the periodicity lemma it has no longer smallest period).
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import id_crc32, read_table, starts, text_slices

PRIME, GENERATOR = 2013265921, 31  # 15 * 2^27 + 1
TOGETHER = 1 << 18  # values transformed at once
STEPS = 32  # words compared in step on either side of all seeds, before the seeds left are followed one by one


@functools.cache
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(1, np.uint64)
    while len(out) < half:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % np.uint64(PRIME)])
    return out.reshape(-1, 1)


def transform(x: np.ndarray) -> np.ndarray:
    """Transform of the columns of ``x`` (a power of two of rows, values below PRIME), in bit-reversed order; ``x`` is overwritten."""
    p, half = np.uint64(PRIME), len(x) // 2
    while half:
        v = x.reshape(-1, 2, half, x.shape[1])
        low = (v[:, 0] + v[:, 1]) % p
        v[:, 1] = (v[:, 0] + (p - v[:, 1])) * _twiddles(half, False) % p
        v[:, 0] = low
        half //= 2
    return x


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """Takes ``transform``'s order back to the columns; ``x`` is overwritten."""
    p, half = np.uint64(PRIME), 1
    while half < len(x):
        v = x.reshape(-1, 2, half, x.shape[1])
        turned = v[:, 1] * _twiddles(half, True) % p
        v[:, 1] = (v[:, 0] + (p - turned)) % p
        v[:, 0] = (v[:, 0] + turned) % p
        half *= 2
    x *= np.uint64(pow(len(x), PRIME - 2, PRIME))
    x %= p
    return x


def zero_mismatches(values: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and distance (``size`` to 2 ``size`` - 1) wherever a block occurs again, by its values.

    ``values`` are so small that a sum of ``size`` squared differences stays below PRIME, and 3 ``size`` of them follow every start.
    """
    p = np.uint64(PRIME)
    begin, distance = [], []
    for i in range(0, len(blocks), max(1, TOGETHER // (2 * size))):
        own = blocks[i:i + max(1, TOGETHER // (2 * size))]
        block = values[np.arange(size).reshape(-1, 1) + own]
        window = values[np.arange(size, 3 * size).reshape(-1, 1) + own]
        turned = np.zeros_like(window)  # the block read backwards from 0: the product is its correlation with the window
        turned[0], turned[-1:-size:-1] = block[0], block[1:]
        product = inverse_transform(transform(turned) * transform(window.copy()) % p)[:size]
        squares = np.zeros((2 * size + 1, len(own)), np.uint64)
        np.cumsum(window * window, axis=0, out=squares[1:])
        total = (block * block).sum(axis=0) + squares[size:2 * size] - squares[:size]
        where, which = np.nonzero((total + 2 * (p - product)) % p == 0)
        begin.append(own[which])
        distance.append(where + size)
    return (np.concatenate(begin), np.concatenate(distance)) if begin else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _agreement(x: np.ndarray, y: np.ndarray) -> int:
    """Number of equal values before the first difference, looked for in pieces that double."""
    at, step = 0, STEPS
    while at < len(x):
        differ = x[at:at + step] != y[at:at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return len(x)


def _extend(words: np.ndarray, s: np.ndarray, d: np.ndarray, size: int, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Longest stretches (start, end, period) around the seeds: words ``d`` apart are equal, between ``low`` and ``high``."""
    left, right = s.copy(), s + size  # the stretch of places i with words[i] == words[i + d]
    ok = np.ones(len(s), bool)
    open_left, open_right = np.ones(len(s), bool), np.ones(len(s), bool)
    for t in range(size if size < STEPS else STEPS):  # values may agree where words do not
        ok &= words[s + t] == words[s + t + d]
    for _ in range(STEPS):
        if not ((open_left | open_right) & ok).any():
            break
        open_left &= left > low
        at = np.flatnonzero(open_left & ok)
        same = words[left[at] - 1] == words[left[at] - 1 + d[at]]
        left[at[same]] -= 1
        open_left[at[~same]] = False
        open_right &= right + d < high
        at = np.flatnonzero(open_right & ok)
        same = words[right[at]] == words[right[at] + d[at]]
        right[at[same]] += 1
        open_right[at[~same]] = False
    # What has ended on both sides and is too short is no run.
    ok &= open_left | open_right | (right - left + d >= np.maximum(6, 4 * d))
    at = np.flatnonzero(ok)
    last = (-1, -1, -1)  # period, start and end of the stretch just followed
    for i in at[np.lexsort((s[at], d[at]))].tolist():
        p, a = int(d[i]), int(s[i])
        if last[0] == p and last[1] <= a and a + size <= last[2]:
            continue
        lo, hi = int(low[i]), int(high[i])
        end = a + _agreement(words[a:hi - p], words[a + p:hi])
        if end < a + size:
            continue
        begin = a - _agreement(words[lo:a][::-1], words[lo + p:a + p][::-1])
        last = (p, begin, end)
        if end + p - begin >= max(6, 4 * p):
            yield begin, end + p, p


def periodic_runs(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period; places are those of ``words`` (any integers).

    A run is a longest stretch inside one piece ``offsets[k]:offsets[k + 1]`` of smallest period q with at least max(6, 4 q) words.
    """
    n = len(words)
    longest = int(np.diff(offsets).max(initial=0))
    if longest < 6:
        return np.zeros((0, 3), np.int64)
    piece = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.argsort(words, kind="stable")
    again = np.full(n, n, np.int64)  # distance to the word's next place in its piece
    same = (words[order[1:]] == words[order[:-1]]) & (piece[order[1:]] == piece[order[:-1]])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    known = np.zeros((0, 3), np.int64)
    size, farthest = 1, again
    while 4 * size <= longest:
        blocks = np.flatnonzero(farthest < 2 * size) * size
        reach = np.maximum.accumulate(known[:, 1]) if len(known) else np.zeros(0, np.int64)

        def inside(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            """Whether begin:end lies in a run of a smaller scale."""
            before = np.searchsorted(known[:, 0], begin, side="right")
            return (before > 0) & (np.append(reach, 0)[before - 1] >= end)

        blocks = blocks[~inside(blocks, blocks + 3 * size)]
        if len(blocks):
            span = int(((PRIME - 1) // size) ** 0.5)
            values = np.zeros(n + 4 * size, np.uint64)
            values[:n] = mixed % np.uint64(span)
            s, d = zero_mismatches(values, blocks, size)
            fits = s + d + size <= n
            s, d = s[fits], d[fits]
            low, high = offsets[piece[s]], offsets[piece[s] + 1]
            fits = (s + d + size <= high) & ~inside(s, s + d + size)
            new = list(_extend(words, s[fits], d[fits], size, low[fits], high[fits]))
            if new:
                known = np.concatenate([known, np.array(sorted(set(new)), np.int64)])
                known = known[np.lexsort((known[:, 2], known[:, 0]))]
        pairs = np.append(farthest, [n] * (len(farthest) % 2)).reshape(-1, 2)
        farthest = pairs.max(axis=1)
        size *= 2
    return known


RUN = "struct<start:long,length:long,period:long>"


def detect_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` of each row; other columns are ignored.

    Words are runs of bytes other than space and 09-0D. ``collapsed`` joins by one space the words that no run contains after its first
    period. Rows are kept one for one; a null text counts as empty, a null id stays null. A text is handled whole, whatever its length.
    """
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            split = [t.encode().split() for t in texts]
            numbers: dict[bytes, int] = defaultdict(count().__next__)  # unseen words are numbered upwards
            flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
            offsets = starts(np.fromiter(map(len, split), np.int64, len(split)))
            found = periodic_runs(flat, offsets)
            of = np.searchsorted(offsets, found[:, 0], side="right") - 1
            own_runs: dict[int, list[list[int]]] = {}
            for doc, (a, b, p) in zip(of.tolist(), found.tolist(), strict=True):
                own_runs.setdefault(doc, []).append([a - int(offsets[doc]), b - a, p])
            collapsed = []
            for doc, own in enumerate(split):
                if doc in own_runs:
                    keep = np.ones(len(own), bool)
                    for a, length, p in own_runs[doc]:
                        keep[a + p:a + length] = False
                    own = [own[i] for i in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(np.diff(offsets)),
                pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in own_runs.get(doc, ())] for doc in range(len(texts))],
                         pa.list_(kind)),
                pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
            .mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` where the words of a tenth of the texts go on periodically from some place on.

    By h, the crc32 of the id as text: if h % 10 is 0, words from a = (h div 10) % n on repeat the p = 1 + (n - a) div (3 + (h div 10) % 8)
    words that begin there, joined by one space. A row with a null id or without words stays as it is.
    """
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w != '')")
    marked = docs.select("doc_id", "text", id_crc32("doc_id").alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    marked = (marked.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("(h div 10) % n")))
              .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)")))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> element_at(words, cast(if(i < a, i, a + (i - a) % p) as int) + 1)), ' ')")
    return marked.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, after a tenth of them got periodic tails, and what is left when runs are collapsed."""
    found = detect_runs(repeated_tails(read_table(spark, sf_dir, "documents", "doc_id", "text")))
    # Greatest length/period by cross-multiplication; of equal ones the first in order stays.
    best = F.expr(f"aggregate(runs, cast(null as {RUN}), (a, x) -> if(a is null or x.length * a.period > a.length * x.period, x, a))")
    listed = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")))

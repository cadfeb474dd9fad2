"""Operator 2: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, and every run of characters that are not letters becomes one space, so a word is seen as " word ". The
features are the n-grams of one to three characters inside such words, hashed to a fixed number of buckets. Training counts
cover all labelled rows that are not held out; the log-probability matrix (buckets x languages) is broadcast, its size
being bounded by the two parameters. Scoring gathers the rows of a batch's features and sums them by document.

The posterior only compares the languages learned, and is near 1 for any long text. Whether a text is of its best language at all
is told by its fit, the mean log-probability of its n-grams, which does not grow with the length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.common import held_out, read_table, segment_sums, starts, text_slices

ORDERS = 3
BUCKET_BITS = 16
ALPHA = 0.5
MAX_LANGUAGES = 256
SLICE_CHARS = 1_000_000
UNKNOWN = "und"
# Few n-grams scatter: a text of n gets SHORT / sqrt(n) added to its fit. A new text may fit by MARGIN less than any training text.
SHORT, MARGIN = 5.0, 0.5

_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Lower-case code of each letter, 32 for any other character; kept by the Python worker."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if (s := chr(c)).isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def _parts(text: str, chars: int) -> list[str]:
    """A very long text cut at spaces; features never span a space, so the parts have the features of the whole."""
    out = []
    while len(text) > chars and (cut := text.rfind(" ", 0, chars)) > 0:
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts' n-grams (int32) in order of the texts, and the offsets of each text."""
    n = len(texts)
    joined = " " + " ".join(texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _fold_table()[codes]
    # Each text is followed by one space of its own; the space before the first text belongs to it.
    owner = np.repeat(np.arange(n), np.fromiter(map(len, texts), np.int64, n) + 1)
    owner = np.concatenate([owner[:1], owner])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    letter = codes != 32
    # Spaces at a seam belong to the text before; an n-gram belongs to the text of its letters.
    found, of = [], []
    mixed = np.zeros(len(codes), np.uint64)
    for order in range(1, ORDERS + 1):
        size = len(codes) - order + 1
        if size <= 0:
            break
        mixed = mixed[:size] * np.uint64(0x100000001B3) + codes[order - 1:] + np.uint64(order)
        if order == 1:
            valid, own = letter, owner
        else:  # at most its first and last character are spaces, and not both alone
            valid = letter[1:size + 1] if order > 2 else letter[:-1] | letter[1:]
            own = owner[1:size + 1] if order > 2 else np.where(letter[:-1], owner[:-1], owner[1:])
        found.append(((mixed[valid] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        of.append(own[valid])
    counts = [np.bincount(o, minlength=n) for o in of]
    offsets = starts(np.sum(counts, axis=0)) if counts else np.zeros(n + 1, np.int64)
    out = np.empty(int(offsets[-1]), np.int32)
    before = offsets[:-1].copy()
    for buckets, count in zip(found, counts, strict=True):
        at = np.arange(len(buckets)) + np.repeat(before - starts(count)[:-1], count)
        out[at] = buckets
        before += count
    return out, offsets


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages (ascending), log-probabilities (buckets x languages, float32) and log priors of the labelled rows.

    Rows without label or letters teach nothing. More than MAX_LANGUAGES labels raise an error.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows, texts in text_slices(batches, "text", SLICE_CHARS):
            labels = rows.column(0).to_pylist()
            for lang in dict.fromkeys(labels):
                if lang not in sums:
                    if len(sums) == MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    sums[lang] = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
                for t in (t for t, own in zip(texts, labels, strict=True) if own == lang):
                    sums[lang][-1] += 1
                parts = [p for t, own in zip(texts, labels, strict=True) if own == lang for p in _parts(t, SLICE_CHARS)]
                buckets, _ = features(parts)
                sums[lang][:-1] += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        for lang, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()),
                                              pa.array(own[some], pa.int64())], ["lang", "bucket", "n"])

    labelled = docs.selectExpr(f"cast(`{label_col}` as string) as lang", f"cast(`{text_col}` as string) as text").dropna()
    # At most MAX_LANGUAGES x (buckets + 1) sums.
    sums = (labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .toArrow())
    langs = sorted(set(sums.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros(((1 << BUCKET_BITS) + 1, len(langs)))
    counts[sums.column("bucket").to_numpy(), [place[x] for x in sums.column("lang").to_pylist()]] = sums.column("n").to_numpy()
    seen, rows = counts[:-1], counts[-1]
    log_p = np.log((seen + ALPHA) / (seen.sum(axis=0) + ALPHA * len(seen))).astype(np.float32)
    return langs, log_p, np.log(np.maximum(rows, 1) / max(rows.sum(), 1))


def score_texts(texts: list[str], log_p: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (-1: no letter), its posterior probability and the fit to it for each text."""
    parts = [_parts(t, SLICE_CHARS) for t in texts]
    buckets, offsets = features([p for own in parts for p in own])
    offsets = offsets[starts(np.fromiter(map(len, parts), np.int64, len(parts)))]
    logs = segment_sums(log_p[buckets], offsets) + prior
    best = logs.argmax(axis=1)
    post = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    n = np.diff(offsets)
    some = np.maximum(n, 1)
    fit = (logs - prior)[np.arange(len(best)), best] / some + SHORT / np.sqrt(some)
    return np.where(n == 0, -1, best), np.where(n == 0, 0.0, post), np.where(n == 0, -np.inf, fit)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str = "text",
            with_fit: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, and ``with_fit`` also ``fit``; a column of such a name is replaced.

    A text that is null or has no letter, or a model without languages, gives "und", score 0 and an endless negative fit. Only the
    text is looked at. Ties go to the language that comes first.
    """
    langs, log_p, prior = model
    shared = docs.sparkSession.sparkContext.broadcast((log_p, prior))
    new = ["lang_pred", "score", "fit"][:3 if with_fit else 2]
    kept = [c for c in docs.columns if c not in new]
    slim = docs.select(*(F.col(f"`{c}`") for c in kept))
    at = kept.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*langs, UNKNOWN]
        for rows, texts in text_slices(batches, at, SLICE_CHARS):
            best, post, fit = (score_texts(texts, *shared.value) if langs else
                               (np.full(len(texts), -1), np.zeros(len(texts)), np.full(len(texts), -np.inf)))
            own = [pa.array([names[i] for i in best.tolist()], pa.string()), pa.array(post, pa.float64()), pa.array(fit, pa.float64())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *own[:len(new)]], [*rows.schema.names, *new])

    schema = T.StructType([*slim.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("fit", T.DoubleType())][:len(kept) + len(new)])
    return slim.mapInArrow(run, schema)


def least_fits(rows: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str = "text") -> dict[str, float]:
    """For each language that a training row is taken for, the fit that a text of it must have: MARGIN below the poorest of all these rows."""
    judged = predict(rows.select(F.col(f"`{text_col}`").alias("text")), model, with_fit=True).where(F.col("fit") > float("-inf"))
    # At most MAX_LANGUAGES rows.
    return {r.lang_pred: r.least - MARGIN for r in judged.groupBy("lang_pred").agg(F.min("fit").alias("least")).collect()}


def training_rows(docs: DataFrame) -> DataFrame:
    """Labelled rows that are not held out (crc32 of the id as text, mod 5, is not 0)."""
    return docs.where(~held_out("doc_id", 5, 0) & F.col("lang").isNotNull())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    model = train(training_rows(read_table(spark, sf_dir, "documents", "doc_id", "lang", "text")))
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out("doc_id", 5, 0))
    return predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")

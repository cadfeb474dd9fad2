"""Helpers shared by the operators: reading tables, cutting texts, and ragged numpy arrays."""

from __future__ import annotations

import ctypes
import functools
import gc
import itertools
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_path

# A part of a batch of texts (in bytes) that is handled at once in Python: bounds a worker's memory whatever Arrow's batch size is.
SLICE_CHARS = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again (cuts the lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_crc32(column: str | Column) -> Column:
    """crc32 of the id written as text, as the held-out rules use it (null for a null id)."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """True for ids whose crc32 leaves ``remainder``; a null id counts as not held out."""
    return F.coalesce(id_crc32(column) % modulus == remainder, F.lit(False))


# What a Python worker keeps from task to task: encoders of the stage it works on, by tokenizer file.
_KEPT: dict = {}


def _stage() -> int | None:
    context = TaskContext.get()
    return context.stageId() if context else None


def give_back() -> None:
    """Drop another stage's encoders and return freed memory to the system: a Python worker goes on to other tasks and would keep its peak."""
    if _KEPT.get("stage") != _stage():
        _KEPT.clear()
    gc.collect()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def text_slices(batches: Iterable[pa.RecordBatch], column: str | int = "text",
                chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of at most about ``chars`` bytes of text (one row at least); null text is ''."""
    give_back()
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start, n = 0, batch.num_rows
        while start < n:
            before = int(ends[start - 1]) if start else 0
            stop = max(int(np.searchsorted(ends, before + chars, side="right")), start + 1)
            part = batch.slice(start, stop - start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            start = stop


def starts(lengths: np.ndarray) -> np.ndarray:
    """Start of each piece, and the end of the last one."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ragged_take(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The pieces ``values[offsets[i]:offsets[i+1]]`` for each i of ``index``, end to end."""
    first = offsets[index]
    lengths = offsets[index + 1] - first
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    at = np.arange(ends[-1]) + np.repeat(first - (ends - lengths), lengths)
    return values[at]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each ragged piece along the first axis; 0 for an empty piece."""
    n = len(offsets) - 1
    out = np.zeros((n, *values.shape[1:]), np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0, dtype=np.float64)
    return out


class Numbering(dict):
    """Numbers unseen keys upwards and remembers them, in order, in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


_IRREGULAR = re.compile(r"[ \n](?:\s|\Z)|\A\n")


def space_chunks(text: str, whole: tuple[str, ...] = ()) -> list[str]:
    """Cut a text before single spaces and line ends, where the byte-level pattern always has a boundary.

    The chunks are keys: one that begins with a space stands for the rest of it (it opened the text), one that begins with
    a line end for itself, any other for itself after a space. A text with a run of white space or with a string of ``whole`` stays whole.
    """
    if _IRREGULAR.search(text) or any(w in text for w in whole):
        return [" " + text]
    chunks = text.replace("\n", " \n").split(" ")
    chunks[0] = " " + chunks[0]
    return chunks


def chunk_text(key: str) -> str:
    """The piece of text that a key of ``space_chunks`` stands for."""
    if key[0] == " ":
        return key[1:]
    return key if key[0] == "\n" else " " + key


# Python's white space as an Arrow pattern writes it, the texts that ``_IRREGULAR`` finds, and chunks that may be encoded together.
_SPACES_RE2 = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_IRREGULAR_RE2 = rf"[ \n](?:[{_SPACES_RE2}]|\z)|\A\n"
_JOINS_RE2 = rf"\A[ \n][^{_SPACES_RE2}]+\z"


def space_chunk_keys(texts: list[str], whole: tuple[str, ...] = ()) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``space_chunks`` of many texts: the keys, each chunk's place among them, and the number of chunks of each text.

    Arrow cuts the texts and finds the different chunks, so that Python sees each of them once.
    """
    column = pa.array(texts, pa.large_string())
    odd = pc.match_substring_regex(column, _IRREGULAR_RE2).to_numpy(zero_copy_only=False)
    for w in whole:
        odd = odd | pc.match_substring(column, w).to_numpy(zero_copy_only=False)
    cut = pc.split_pattern(pc.replace_substring(column.filter(pa.array(~odd)), "\n", " \n"), " ")
    edges = cut.offsets.to_numpy()
    chunks = cut.flatten()
    opens = np.zeros(len(chunks), bool)
    opens[edges[:-1] - edges[0]] = True
    # A text's first chunk, or a whole text, is another key than the same characters after a space.
    rest = chunks.filter(pa.array(~opens)).dictionary_encode()
    counts = np.ones(len(texts), np.int64)
    counts[~odd] = np.diff(edges)
    first = np.zeros(int(counts.sum()), bool)
    first[starts(counts)[:-1]] = True
    keys = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
    places = np.empty(len(first), np.int64)
    places[~first] = rest.indices.to_numpy(zero_copy_only=False)
    places[first] = np.arange(len(keys), len(keys) + len(texts))
    opening = np.empty(len(texts), object)
    opening[~odd] = chunks.filter(pa.array(opens)).to_numpy(zero_copy_only=False)
    opening[odd] = column.filter(pa.array(odd)).to_numpy(zero_copy_only=False)
    return keys + [" " + t for t in opening], places, counts


_WIDE = re.compile("[^\x00-\u024f]")


def word_chunks(text: str, whole: tuple[str, ...] = ()) -> list[str]:
    """Cut a text at spaces and line ends, for a tokenizer that lower-cases and drops white space.

    Lower case comes first, to have fewer distinct chunks, unless the text holds characters beyond Latin, whose lower case may
    hang together with their neighbours. A text with a string of ``whole``, in whatever case, stays whole and in its own case.
    """
    own = text
    if not _WIDE.search(text):
        text = text.lower()
    if any(w in text or w.lower() in text for w in whole):
        return [own]
    return text.replace("\n", " ").split(" ")


def word_chunk_keys(texts: list[str], whole: tuple[str, ...] = ()) -> tuple[list[str], slice, np.ndarray]:
    """``word_chunks`` of many texts, end to end, as ``space_chunk_keys`` has them."""
    chunks: list[str] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = word_chunks(text, whole)
        counts[i] = len(own)
        chunks += own
    return chunks, slice(None), counts


class ChunkEncoder:
    """Token ids of whole texts: chunks are encoded once by ``encode`` and remembered, up to a bound.

    ``encode`` takes a list of chunk texts and returns their ids end to end and each one's number of ids.
    """

    MOST_CHUNKS, MOST_CHARS = 1_100_000, 24_000_000

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 split: Callable[[list[str]], tuple[list[str], np.ndarray | slice, np.ndarray]] = space_chunk_keys,
                 text_of: Callable[[str], str] = chunk_text) -> None:
        self.encode, self.split, self.text_of = encode, split, text_of
        self._forget()

    def _forget(self) -> None:
        self.known, self.chars = Numbering(), 0
        self.ids, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (uint32), and the offsets of each text among them."""
        if len(self.known) > self.MOST_CHUNKS or self.chars > self.MOST_CHARS:
            self._forget()
        keys, places, counts = self.split(texts)
        index = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[places]
        if new := self.known.new:
            self.chars += sum(map(len, new))
            ids, lengths = self.encode([self.text_of(k) for k in new])
            self.known.new = []
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
        flat = ragged_take(self.ids, self.offsets, index)
        per_chunk = starts(self.offsets[index + 1] - self.offsets[index])
        return flat, per_chunk[starts(counts)]


@functools.cache
def _library(path: str, added_tokens: bool = False):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if not added_tokens:
        tokenizer.encode_special_tokens = True
    return tokenizer


def _flat(encodings: list) -> tuple[np.ndarray, np.ndarray]:
    ids = [e.ids for e in encodings]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


def added_strings(path: str) -> tuple[str, ...]:
    """The strings of a tokenizer file's added tokens, which the library looks for before it normalises or cuts a text."""
    return tuple(sorted({t.content for t in _library(path, True).get_added_tokens_decoder().values()}))


def library_encoder(path: str, added_tokens: bool = False) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """``encode`` for a ChunkEncoder by the tokenizers library; special tokens' strings are ordinary text without ``added_tokens``."""
    tokenizer = _library(path, added_tokens)
    return lambda texts: _flat(tokenizer.encode_batch_fast(texts, add_special_tokens=False))


def byte_level_encoder(path: str, together: int = 200, added_tokens: bool = False) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """``library_encoder`` for a byte-level vocabulary and chunks of ``space_chunks``.

    Chunks that begin with one space or line end are encoded ``together`` as one text; the tokens' lengths in bytes tell
    where each chunk ends. Texts with an added token's string are encoded by themselves.
    """
    tokenizer = _library(path, added_tokens)
    whole = added_strings(path) if added_tokens else ()
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    widths = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        widths[i] = len(token)  # a byte-level token has one character for each byte

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(texts, pa.large_string())
        plain = pc.match_substring_regex(column, _JOINS_RE2).to_numpy(zero_copy_only=False)
        for w in whole:
            plain = plain & ~pc.match_substring(column, w).to_numpy(zero_copy_only=False)
        joined = list(itertools.compress(texts, plain.tolist()))
        flat, lengths = _flat(tokenizer.encode_batch_fast(
            ["".join(joined[i:i + together]) for i in range(0, len(joined), together)], add_special_tokens=False))
        ends = np.cumsum(pc.binary_length(column).to_numpy()[plain])
        cuts = np.searchsorted(np.cumsum(widths[flat]), ends) + 1
        if plain.all():
            return flat, np.diff(cuts, prepend=0)
        odd, odd_lengths = _flat(tokenizer.encode_batch_fast([t for t, p in zip(texts, plain.tolist(), strict=True) if not p],
                                                             add_special_tokens=False))
        lengths = np.empty(len(texts), np.int64)
        lengths[plain], lengths[~plain] = np.diff(cuts, prepend=0), odd_lengths
        # Both kinds end to end, then back in the order of the texts.
        own = np.concatenate([np.diff(cuts, prepend=0), odd_lengths])
        order = np.empty(len(texts), np.int64)
        order[plain], order[~plain] = np.arange(len(joined)), np.arange(len(joined), len(texts))
        return ragged_take(np.concatenate([flat, odd]), starts(own), order), lengths

    return encode


def library_chunks(path: str, byte_level: bool = True, added_tokens: bool = False) -> ChunkEncoder:
    """A ChunkEncoder for a tokenizer file; what it remembers serves the worker's further tasks of the same stage.

    With ``added_tokens`` the string of an added token (such as <|endoftext|>) in a text becomes its one id, which is the library's
    default; without, it is ordinary text.
    """
    if _KEPT.get("stage") != _stage() or (path, added_tokens) not in _KEPT:
        _KEPT.clear()
        whole = added_strings(path) if added_tokens else ()
        encoder = (ChunkEncoder(byte_level_encoder(path, added_tokens=added_tokens), functools.partial(space_chunk_keys, whole=whole)) if byte_level else
                   ChunkEncoder(library_encoder(path, added_tokens), functools.partial(word_chunk_keys, whole=whole), lambda c: c))
        _KEPT.update({"stage": _stage(), (path, added_tokens): encoder})
    return _KEPT[path, added_tokens]

"""Operator 11: alignment of two tokenizers by as-of joins, and corpus counts of the linked ids.

Both tokenizers cut the same bytes, a space and the text. Each token's start looks backward for the other side's token that covers it
(``pandas.merge_asof``, keyed by the piece of a document); the union of both directions gives all overlaps. An overlap whose two tokens
end together closes a group. Neither vocabulary has a token across the beginning of a word after a space or of a line, so documents are
cut there into pieces (an irregular one stays whole) and equal pieces are tokenised and aligned once; a document's groups are those of its pieces.

How many documents hold a pair of ids linked is counted over the whole corpus in two passes. The first writes a row for each slice of
documents: their own figures, their distinct links with multiplicities (packed and compressed), and the slice's distinct links with the
number of documents, packed by buckets of A ids. The second sums these by link within each bucket, takes each A id's highest count and sends
every slice the counts of its links. The JVM moves a row for each slice and bucket, not one for each link, and few large rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import Numbering, byte_level_encoder, give_back, ragged_take, read_table, segment_sums, starts, text_slices
from marketlens.session import BASE_CONF, scratch_path

SLICE_CHARS = 2_000_000  # a slice's row stays below half a megabyte for most texts; larger ones lie badly in the JVM's heap
PART_CHARS = 1_000_000  # of a slice aligned at once: bounds a worker's memory, while a slice's links, sent through the cluster, stay few
MOST_PIECES, MOST_CHARS = 300_000, 12_000_000
SLICES_TOGETHER = 4  # in a row group of what is written
BUCKETS = 512  # of A ids: the links of one are counted together in a worker
LARGE_BUCKET = 50_000  # links asked; above, a worker gives memory back before it counts them
LARGE_GROUP = 1_024  # pairs of tokens; above, equal ids of a group are taken together before pairing

_IRREGULAR = re.compile(r"[ \n](?:\s|\Z)|\A\s|▁")


def text_pieces(text: str) -> list[str]:
    """Keys of the pieces of a space and the text: one that opens with a space or a line end stands for itself, another for itself after a space."""
    if _IRREGULAR.search(text):
        return [" " + text]
    return text.replace("\n", " \n").split(" ")


def piece_text(key: str) -> str:
    return key if key[:1] in (" ", "\n") else " " + key


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: printable ones for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _flat_bytes(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), starts(np.fromiter(map(len, tokens), np.int64, len(tokens)))


class ByteLevelSide:
    """Ids and token bytes of a byte-level tokenizer file; special tokens' strings are ordinary text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.encode = byte_level_encoder(path)
        values = byte_values()
        vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
        self.bytes, self.offsets = _flat_bytes(tokens)


_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class SentencePieceSide:
    """Ids and token bytes of a sentencepiece model that puts a space before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes, self.offsets = _flat_bytes([bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(t)) else t.replace("▁", " ").encode() for t in names])
        self.space = self.model.piece_to_id("▁")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that open with a space, which the model adds itself, or with a line end, before which it is taken off again."""
        ids = self.model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            if t[0] != " " and ids[i][:1] == [self.space]:
                del ids[i][0]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for own in ids for x in own), np.uint32, int(lengths.sum())), lengths


def overlaps(a_start: np.ndarray, a_piece: np.ndarray, b_start: np.ndarray, b_piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (token of A, token of B) of all tokens that share bytes, in order; each side covers the same bytes of the same pieces."""
    a = pd.DataFrame({"start": a_start, "piece": a_piece, "a": np.arange(len(a_start))})
    b = pd.DataFrame({"start": b_start, "piece": b_piece, "b": np.arange(len(b_start))})
    covering = [pd.merge_asof(a, b, on="start", by="piece"), pd.merge_asof(b, a, on="start", by="piece")]
    both = np.unique(np.concatenate([c["a"].to_numpy(np.int64) * max(len(b), 1) + c["b"].to_numpy(np.int64) for c in covering]))
    return both // max(len(b), 1), both % max(len(b), 1)


class Alignment:
    """Tokens, groups and links of some pieces, laid end to end."""

    def __init__(self, a_side, b_side, texts: list[str]) -> None:
        """``texts`` are pieces' whole texts; of a piece that a side does not give back byte by byte nothing is kept (``whole`` is false)."""
        n = len(texts)
        (self.a, a_len), (self.b, b_len) = a_side.encode(texts), b_side.encode(texts)
        raw = [t.encode() for t in texts]
        self.whole = np.ones(n, bool)
        size = np.fromiter(map(len, raw), np.int64, n)
        for side, ids, lengths in ((a_side, self.a, a_len), (b_side, self.b, b_len)):
            widths = side.offsets[ids.astype(np.int64) + 1] - side.offsets[ids]
            same = segment_sums(widths, starts(lengths)).astype(np.int64) == size
            if not same.all():  # compare what can be laid side by side
                self.whole &= same
        for side, ids, lengths in ((a_side, self.a, a_len), (b_side, self.b, b_len)):
            kept = ids[np.repeat(self.whole, lengths)].astype(np.int64)
            joined = ragged_take(side.bytes, side.offsets, kept)
            want = np.frombuffer(b"".join(t for t, w in zip(raw, self.whole.tolist(), strict=True) if w), np.uint8)
            differ = np.flatnonzero(joined != want)
            if len(differ):
                at = np.flatnonzero(self.whole)
                self.whole[at[np.searchsorted(np.cumsum(size[at]), differ, side="right")]] = False
                self.__init__(_Kept(a_side, self.a, a_len, self.whole), _Kept(b_side, self.b, b_len, self.whole), texts)
                return
        self.a, self.b = self.a[np.repeat(self.whole, a_len)], self.b[np.repeat(self.whole, b_len)]
        self.a_len, self.b_len = a_len * self.whole, b_len * self.whole
        a_piece, b_piece = np.repeat(np.arange(n), self.a_len), np.repeat(np.arange(n), self.b_len)
        a_end = np.cumsum(a_side.offsets[self.a.astype(np.int64) + 1] - a_side.offsets[self.a])
        b_end = np.cumsum(b_side.offsets[self.b.astype(np.int64) + 1] - b_side.offsets[self.b])
        a_start, b_start = np.append(0, a_end)[:len(self.a)], np.append(0, b_end)[:len(self.b)]
        self.over_a, self.over_b = overlaps(a_start, a_piece, b_start, b_piece)
        together = a_end[self.over_a] == b_end[self.over_b]
        self.a_last, self.b_last = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        self.a_last[self.over_a[together]] = True
        self.b_last[self.over_b[together]] = True
        # First token of each group on either side, and after the last.
        self.a_group = np.concatenate([[0], np.flatnonzero(self.a_last) + 1])
        self.b_group = np.concatenate([[0], np.flatnonzero(self.b_last) + 1])
        self.groups = np.bincount(a_piece[self.a_last], minlength=n)

    def links(self, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code ``a * base + b`` and multiplicity of the linked ids, group by group, and the number of such entries of each group."""
        m, k = np.diff(self.a_group), np.diff(self.b_group)
        counts = m * k
        large = np.flatnonzero(counts > LARGE_GROUP)
        extra = []
        for g in large.tolist():
            a, na = np.unique(self.a[self.a_group[g]:self.a_group[g + 1]].astype(np.int64), return_counts=True)
            b, nb = np.unique(self.b[self.b_group[g]:self.b_group[g + 1]].astype(np.int64), return_counts=True)
            extra.append(((a[:, None] * base + b).ravel(), (na[:, None] * nb).ravel()))
            counts[g] = len(extra[-1][0])
        of = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(of)) - np.repeat(starts(counts)[:-1], counts)
        multiple = np.ones(len(of), np.int64)
        small = np.ones(len(counts), bool)
        small[large] = False
        plain = np.flatnonzero(small[of])
        g, i = of[plain], at[plain]
        codes = np.empty(len(of), np.int64)
        codes[plain] = self.a[self.a_group[g] + i // k[g]].astype(np.int64) * base + self.b[self.b_group[g] + i % k[g]]
        edges = starts(counts)
        for group, (own, times) in zip(large.tolist(), extra, strict=True):
            codes[edges[group]:edges[group + 1]], multiple[edges[group]:edges[group + 1]] = own, times
        return codes, multiple, counts

    def listed(self, table: tuple[np.ndarray, np.ndarray], largest: int) -> list[bytes]:
        """Text of each piece's groups: ``a1,a2|b1;`` and so on. ``table`` is that of ``decimal_table(largest)``."""
        m, k = np.diff(self.a_group), np.diff(self.b_group)
        group_a, group_b = np.repeat(np.arange(len(m)), m), np.repeat(np.arange(len(k)), k)
        symbols = np.empty(len(self.a) + len(self.b), np.int64)
        symbols[np.arange(len(self.a)) + self.b_group[group_a]] = self.a + self.a_last.astype(np.int64) * largest
        symbols[np.arange(len(self.b)) + self.a_group[group_b + 1]] = self.b + self.b_last.astype(np.int64) * (2 * largest)
        text = ragged_take(*table, symbols).tobytes()
        sizes = np.concatenate([[0], np.cumsum(table[1][symbols + 1] - table[1][symbols])])
        edges = sizes[starts(self.a_len + self.b_len)].tolist()
        return [text[i:j] for i, j in zip(edges, edges[1:], strict=False)]


class _Kept:
    """A side whose ids are known already; those of pieces that are not whole are left out."""

    def __init__(self, side, ids: np.ndarray, lengths: np.ndarray, whole: np.ndarray) -> None:
        self.bytes, self.offsets = side.bytes, side.offsets
        self.known = ids[np.repeat(whole, lengths)], lengths * whole

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.known


@functools.cache
def decimal_table(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of ``id,`` for ids below ``largest``, then of ``id|``, then of ``id;``."""
    return _flat_bytes([b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(largest)])


class PieceAligner:
    """Aligns the distinct pieces of texts and remembers them, up to a bound."""

    def __init__(self, a_side, b_side) -> None:
        self.sides = a_side, b_side
        self.base = len(b_side.offsets) - 1
        self.largest = max(len(a_side.offsets), len(b_side.offsets)) - 1
        self._forget()

    def _forget(self) -> None:
        self.known, self.chars = Numbering(), 0
        self.figures = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, whether whole
        self.listed: list[bytes] = []
        self.codes, self.multiple, self.code_offsets = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of each piece of the texts, end to end, and the offsets of the texts among them; an empty text has none."""
        if len(self.known) > MOST_PIECES or self.chars > MOST_CHARS:
            self._forget()
        keys: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                own = text_pieces(text)
                counts[i] = len(own)
                keys += own
        numbers = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        if new := self.known.new:
            self.chars += sum(map(len, new))
            part = Alignment(*self.sides, [piece_text(k) for k in new])
            self.known.new = []
            codes, multiple, per_group = part.links(self.base)
            self.figures = np.concatenate([self.figures, np.stack([part.a_len, part.b_len, part.groups, part.whole], axis=1)])
            self.listed += part.listed(decimal_table(self.largest), self.largest)
            self.codes, self.multiple = np.concatenate([self.codes, codes]), np.concatenate([self.multiple, multiple])
            ends = starts(per_group)[starts(part.groups)[1:]]
            self.code_offsets = np.concatenate([self.code_offsets, self.code_offsets[-1] + ends])
        return numbers, starts(counts)


_LONGS = pa.list_(pa.int64())
SLICE_SCHEMA = pa.schema([
    ("slice", pa.int64()), ("doc_ids", _LONGS), ("has_id", pa.list_(pa.bool_())), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS),
    ("n_links", _LONGS), ("groups_sha256", pa.list_(pa.string())),
    ("n_distinct", _LONGS), ("links", pa.binary()), ("times", pa.binary()),  # each document's links (steps of int32 places among those asked), and their multiplicities
    # The slice's distinct links by buckets and in order, and how many of its documents hold each (int64 and int32).
    ("asked", pa.list_(pa.struct([("bucket", pa.int32()), ("codes", pa.binary()), ("n_docs", pa.binary())])))])
SLICES = ("slice long, doc_ids array<long>, has_id array<boolean>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, n_distinct array<long>, links binary, times binary, asked array<struct<bucket: int, codes: binary, n_docs: binary>>")


def packed(values: np.ndarray) -> bytes:
    """Compressed, as the JVM holds a slice's row at several places."""
    return pa.compress(values.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


def by_bucket(buckets: np.ndarray, codes: np.ndarray, n_docs: np.ndarray) -> list[dict]:
    edges = np.append(np.flatnonzero(np.diff(buckets, prepend=-1)), len(buckets)).tolist()
    return [{"bucket": int(buckets[i]), "codes": codes[i:j].tobytes(), "n_docs": n_docs[i:j].tobytes()} for i, j in zip(edges, edges[1:], strict=False)]


def text_parts(texts: list[str], chars: int = PART_CHARS) -> Iterator[list[str]]:
    """Runs of texts of at most ``chars`` characters (one text at least)."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(text)
    yield texts[begin:]


def text_links(aligner: PieceAligner, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Each text's numbers of tokens of A, of B, groups and links, and its groups_sha256 and number of distinct links; these links' codes and multiplicities."""
    numbers, offsets = aligner(texts)
    figures = segment_sums(aligner.figures[numbers], offsets).astype(np.int64)
    whole = figures[:, 3] == np.diff(offsets)
    kept = np.repeat(whole, np.diff(offsets))
    piece_links = aligner.code_offsets[numbers + 1] - aligner.code_offsets[numbers]
    of = np.repeat(np.repeat(np.arange(len(texts)), np.diff(offsets))[kept], piece_links[kept])
    codes = ragged_take(aligner.codes, aligner.code_offsets, numbers[kept])
    times = ragged_take(aligner.multiple, aligner.code_offsets, numbers[kept])
    space = (len(aligner.sides[0].offsets) - 1) * aligner.base
    if len(texts) * space >= 1 << 62:
        raise ValueError("too many documents in a slice for these vocabularies")
    distinct = of * space + codes
    if (times == 1).all():
        distinct, times = np.unique(distinct, return_counts=True)
    else:
        order = np.argsort(distinct, kind="stable")
        distinct = distinct[order]
        first = np.flatnonzero(np.concatenate([[True], distinct[1:] != distinct[:-1]]))
        distinct, times = distinct[first], np.add.reduceat(times[order], first)
    of, codes = distinct // space, distinct % space
    digests = []
    for i, ok in enumerate(whole.tolist()):
        joined = b"".join(map(aligner.listed.__getitem__, numbers[offsets[i]:offsets[i + 1]].tolist())) if ok else b""
        digests.append(hashlib.sha256(joined[:-1]).hexdigest() if joined else "")
    n_distinct = np.bincount(of, minlength=len(texts))
    n_links = segment_sums(times, starts(n_distinct)).astype(np.int64)
    return np.column_stack([figures[:, :3] * whole[:, None], n_links]), digests, n_distinct, codes, times


@contextmanager
def texts_in_small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Parquet columns are read in batches as small as those that go to Python: a batch of 4096 texts is a large array of the JVM's heap."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), int(BASE_CONF["spark.sql.execution.arrow.maxRecordsPerBatch"])))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_alignments(docs: DataFrame, path: str, byte_level_file: str, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Align the documents and write a row for each slice of them to ``path``; returns the number of B's ids, by which link codes divide.

    A null text counts as empty. Texts that are empty, or that a side does not give back byte by byte, have no tokens.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = PieceAligner(ByteLevelSide(byte_level_file), SentencePieceSide(model_file))
        number = TaskContext.get().partitionId() << 32
        for part, texts in text_slices(batches, chars=SLICE_CHARS):
            figures, digests, n_distinct, codes, times = zip(*(text_links(aligner, own) for own in text_parts(texts)), strict=True)
            codes, times, n_distinct = np.concatenate(codes), np.concatenate(times), np.concatenate(n_distinct)
            space = (len(aligner.sides[0].offsets) - 1) * aligner.base
            own, index = np.unique(codes // aligner.base % BUCKETS * space + codes, return_inverse=True)
            order = np.argsort(np.repeat(np.arange(len(texts)), n_distinct) * len(own) + index)  # each document's links by place: small steps
            columns = [number, pc.fill_null(part.column(0), 0).to_pylist(), pc.is_valid(part.column(0)).to_pylist(),
                       *np.concatenate(figures).T.tolist(), [d for own_digests in digests for d in own_digests],
                       n_distinct.tolist(), packed(np.diff(index[order], prepend=0).astype(np.int32)), packed(times[order].astype(np.int64)),
                       by_bucket(own // space, own % space, np.bincount(index, minlength=len(own)).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, SLICE_SCHEMA, strict=True)], schema=SLICE_SCHEMA)
            number += 1
        # The worker stays beside the JVM after its last task.
        del aligner
        give_back()
        pa.default_memory_pool().release_unused()

    with texts_in_small_batches(docs.sparkSession):
        # The reader holds up to a whole row group at once.
        (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text").mapInArrow(run, SLICES)
         .write.options(**{"compression": "zstd", "parquet.block.row.count.limit": SLICES_TOGETHER}).mode("errorifexists").parquet(path))
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file).get_piece_size()


def counted_links(codes: np.ndarray, n_docs: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry how many documents hold its link over all entries, and whether no link of its A id is held by more; all entries of an A id are given."""
    own, index = np.unique(codes, return_inverse=True)
    totals = np.zeros(len(own), np.int64)
    np.add.at(totals, index, n_docs)
    firsts = np.flatnonzero(np.diff(own // base, prepend=-1))
    most = np.maximum.reduceat(totals, firsts) if len(own) else totals
    best = totals == np.repeat(most, np.diff(np.append(firsts, len(own))))
    return totals[index], best[index]


def link_counts(spark: SparkSession, path: str, base: int) -> DataFrame:
    """``slice``, ``bucket`` and ``answers``: for each link asked, in its order, 2 * n_docs (documents of all slices that hold it), 1 more for a best one."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        codes = np.frombuffer(b"".join(rows["codes"]), np.int64)
        if len(codes) > LARGE_BUCKET:
            give_back()
        n_docs, best = counted_links(codes, np.frombuffer(b"".join(rows["n_docs"]), np.int32), base)
        answers, edges = n_docs * 2 + best, starts(rows["codes"].map(len).to_numpy(np.int64) // 8).tolist()
        return rows[["slice", "bucket"]].assign(answers=[answers[i:j].tobytes() for i, j in zip(edges, edges[1:], strict=False)])

    asked = spark.read.schema(SLICES).parquet(path).select("slice", F.inline("asked"))
    return asked.groupBy("bucket").applyInPandas(run, "slice long, bucket int, answers binary")


def document_links(spark: SparkSession, path: str, base: int) -> DataFrame:
    """Figures of each document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, by what ``write_alignments`` has written."""
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        answers = np.frombuffer(b"".join(told.sort_values("bucket")["answers"]), np.int64)
        n, best = answers >> 1, answers & 1
        own = starts(np.asarray(row["n_distinct"], np.int64))
        link, times = np.cumsum(unpacked(row["links"], np.int32, own[-1])), unpacked(row["times"], np.int64, own[-1])
        sums = [np.add.reduceat(np.append(v, 0), own[:-1]) * (np.diff(own) > 0) for v in (times * best[link], times * n[link])]
        ids = pd.Series(row["doc_ids"], dtype="Int64").where(pd.Series(row["has_id"], dtype=bool))
        values = [ids, row["n_a"], row["n_b"], row["n_groups"], row["n_links"], *sums, row["groups_sha256"]]
        return pd.DataFrame(dict(zip(columns, values, strict=True)))

    slices = spark.read.schema(SLICES).parquet(path).drop("asked")
    return (slices.groupBy("slice").cogroup(link_counts(spark, path, base).groupBy("slice"))
            .applyInPandas(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))


def align_documents(docs: DataFrame, byte_level_file: str, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the ids ``a`` and ``b``, ``groups`` (first token of each group on either side) and ``overlaps`` (numbers of tokens that share bytes).

    One row for each row of ``docs``; null, empty and texts that a side does not give back byte by byte have empty lists.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = ByteLevelSide(byte_level_file), SentencePieceSide(model_file)
        pair = pa.struct([("a", pa.int32()), ("b", pa.int32())])
        for part, texts in text_slices(batches, chars=SLICE_CHARS):
            # The space of an empty text is not to be encoded.
            found = Alignment(*sides, [" " + t for t in texts])
            empty = np.fromiter((not t for t in texts), bool, len(texts))
            a_edge, b_edge = starts(found.a_len), starts(found.b_len)
            group_edge = starts(found.groups)
            over = np.searchsorted(found.over_a, a_edge)
            rows: list[list] = [[], [], [], []]
            for i in range(len(texts)):
                a, b = slice(a_edge[i], a_edge[i + 1]), slice(b_edge[i], b_edge[i + 1])
                g, o = slice(group_edge[i], group_edge[i + 1]), slice(over[i], over[i + 1])
                own = ([], [], [], []) if empty[i] else (
                    found.a[a].tolist(), found.b[b].tolist(),
                    [{"a": int(x - a.start), "b": int(y - b.start)} for x, y in zip(found.a_group[g], found.b_group[g], strict=True)],
                    [{"a": int(x - a.start), "b": int(y - b.start)} for x, y in zip(found.over_a[o], found.over_b[o], strict=True)])
                for column, value in zip(rows, own, strict=True):
                    column.append(value)
            kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pair)] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))],
                                             ["doc_id", "a", "b", "groups", "overlaps"])

    return (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
            .mapInArrow(run, "doc_id long, a array<int>, b array<int>, groups array<struct<a:int,b:int>>, overlaps array<struct<a:int,b:int>>"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of a byte-level and a sentencepiece vocabulary over every whole text of ``documents``."""
    import public_tokenizers

    path = scratch_path(spark, "op11-alignments")
    base = write_alignments(read_table(spark, sf_dir, "documents", "doc_id", "text"), path,
                            public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return document_links(spark, path, base)

"""Operator 3: byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pairs wait in buckets by merge rank; a bucket holds positions in a linked list of tokens. A bitmap of three levels over the
ranks finds the next bucket by find-first-set. An entry whose pair has changed since it was queued is stale and skipped.
All pre-tokens of a batch share one list and one queue: they have no common pairs, so the lowest rank overall is also the
lowest one of the pre-token it lies in. A pop takes all occurrences of the rank at once, except in pre-tokens where a merge
would bring up a lower rank in between; there it takes the leftmost only. So a very long pre-token costs a few array passes
per rank, not one step per merge.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import ChunkEncoder, ragged_take, read_table, starts, text_slices

NO_RANK = np.int32(2**31 - 1)


class RankBitmap:
    """Set of ranks below 64**3 as a bitmap of three levels; ``first`` is a find-first-set on each level."""

    def __init__(self) -> None:
        self.top, self.mid, self.low = 0, [0] * 64, [0] * 4096

    def add(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def remove(self, rank: int) -> None:
        a, b = rank >> 6, rank >> 12
        self.low[a] &= ~(1 << (rank & 63))
        if not self.low[a]:
            self.mid[b] &= ~(1 << (a & 63))
            if not self.mid[b]:
                self.top &= ~(1 << b)

    def first(self) -> int:
        """The smallest rank, -1 if none is left."""
        if not self.top:
            return -1
        b = (self.top & -self.top).bit_length() - 1
        a = b << 6 | (self.mid[b] & -self.mid[b]).bit_length() - 1
        return a << 6 | (self.low[a] & -self.low[a]).bit_length() - 1


class RankQueue:
    """Buckets of positions per rank, the next bucket found by the bitmap."""

    def __init__(self) -> None:
        self.bits, self.buckets = RankBitmap(), {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        keep = ranks != NO_RANK
        ranks, positions = ranks[keep], positions[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = [positions[a:b]]
                self.bits.add(rank)
            else:
                bucket.append(positions[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions, ascending; rank -1 when the queue is empty."""
        rank = self.bits.first()
        if rank < 0:
            return rank, np.zeros(0, np.int64)
        self.bits.remove(rank)
        bucket = self.buckets.pop(rank)
        return rank, np.unique(np.concatenate(bucket)) if len(bucket) > 1 else np.sort(bucket[0])


class ByteBPE:
    """Encoder and decoder for a rank file (lines of base64 token and rank; a token's rank is its id)."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        with open(rank_file, "rb") as f:
            tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(tokens.values()) >= 64**3:
            raise ValueError("the rank queue holds ranks below 262144")
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        rows = [(tokens[t[:i]] << 18 | tokens[t[i:]], r) for t, r in tokens.items() if len(t) > 1
                for i in range(1, len(t)) if t[:i] in tokens and t[i:] in tokens]
        pairs = np.array(sorted(rows), np.int64).reshape(-1, 2)
        self._hash_pairs(pairs[:, 0], pairs[:, 1].astype(np.int32))
        by_id = [b""] * (max(tokens.values()) + 1)
        for t, r in tokens.items():
            by_id[r] = t
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_offsets = starts(np.array([len(t) for t in by_id]))
        decimals = [b"%d," % i for i in range(len(by_id))]
        self.decimals = np.frombuffer(b"".join(decimals), np.uint8)
        self.decimal_offsets = starts(np.array([len(t) for t in decimals]))

    def _hash_pairs(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open-addressing table of the pairs, at most a quarter full."""
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], ranks[won]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NO_RANK where the pair doesn't merge or either id is negative."""
        keys = left.astype(np.int64) << 18 | right
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[todo])
        while len(todo):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != -1)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def encode_pretokens(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and each piece's number of ids."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(lengths.sum())
        # Position n closes the list: its token is -1, which never merges.
        tok = np.empty(n + 1, np.int32)
        tok[:n], tok[n] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], -1
        piece = np.repeat(np.arange(len(pieces)), lengths)
        at = np.arange(n)
        nxt, prv = at + 1, at - 1
        edge = starts(lengths)
        full = lengths > 0
        nxt[edge[1:][full] - 1] = n
        prv[edge[:-1][full]] = n
        alive = np.ones(n, bool)
        rank = self.pair_ranks(tok[:n], tok[nxt])
        taken = np.zeros(n + 1, bool)  # right halves of the pairs that a pop is about to merge
        queue = RankQueue()
        queue.push(rank, at)
        while True:
            r, pos = queue.pop()
            if r < 0:
                break
            pos = pos[rank[pos] == r]  # the others are stale
            if not len(pos):
                continue
            # Of pairs that overlap in a row ("aaaa"), every second one merges, from the left.
            first = np.ones(len(pos), bool)
            first[1:] = nxt[pos[:-1]] != pos[1:]
            k = np.arange(len(pos))
            pos = pos[(k - np.maximum.accumulate(np.where(first, k, 0))) % 2 == 0]
            right = nxt[pos]
            before, after = prv[pos], nxt[right]
            taken[right] = True
            merged = np.full(len(pos), r, np.int32)
            lower = self.pair_ranks(np.where(taken[before], np.int32(r), tok[before]), merged) < r
            lower |= self.pair_ranks(merged, tok[after]) < r
            taken[right] = False
            if lower.any():
                own = piece[pos]
                head = np.ones(len(pos), bool)
                head[1:] = own[1:] != own[:-1]
                alone = np.isin(own, own[lower]) & ~head
                queue.push(merged[alone], pos[alone])
                pos, right, before, after = (x[~alone] for x in (pos, right, before, after))
            tok[pos] = r
            alive[right] = False
            rank[right] = NO_RANK
            nxt[pos] = after
            inner = after < n
            prv[after[inner]] = pos[inner]
            before = prv[pos]  # a left neighbour that merged too is now its own left half
            changed = np.unique(np.concatenate([pos, before[before < n]]))
            rank[changed] = self.pair_ranks(tok[changed], tok[nxt[changed]])
            queue.push(rank[changed], changed)
        counts = np.bincount(piece[alive], minlength=len(pieces)) if n else np.zeros(len(pieces), np.int64)
        return tok[:n][alive].astype(np.uint32), counts

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each match of the pattern by itself; equal pre-tokens of the call are encoded once."""
        numbers: dict[str, int] = {}
        found = [self.pattern.findall(t) for t in texts]
        index = np.fromiter((numbers.setdefault(w, len(numbers)) for own in found for w in own), np.int64)
        ids, lengths = self.encode_pretokens([w.encode() for w in numbers])
        offsets = starts(lengths)
        per_word = starts(lengths[index])
        per_text = per_word[starts(np.fromiter(map(len, found), np.int64, len(found)))]
        return ragged_take(ids, offsets, index), np.diff(per_text)

    def decode(self, ids: np.ndarray) -> bytes:
        return ragged_take(self.token_bytes, self.token_offsets, ids.astype(np.int64)).tobytes()

    def decimal_text(self, ids: np.ndarray) -> bytes:
        """Ids in decimals, joined by commas."""
        return ragged_take(self.decimals, self.decimal_offsets, ids.astype(np.int64)).tobytes()[:-1]


def _encoded(batches: Iterable[pa.RecordBatch], bpe: ByteBPE) -> Iterator[tuple[pa.Array, list[np.ndarray], list[bytes]]]:
    """Id column, ids and decoded bytes of the documents of each slice."""
    encoder = ChunkEncoder(bpe.encode_texts)
    for part, texts in text_slices(batches):
        ids, offsets = encoder(texts)
        each = [ids[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        yield part.column(0), each, [bpe.decode(x) for x in each]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` (binary) of each row; a null text counts as empty.

    With ``digests``, ``n_tokens`` and the SHA-256 of the ids in decimals and of the decoded bytes stand in their place,
    taken in the task that has them. Rows are kept one for one: repeated rows give repeated results, a null id stays
    null, other columns are ignored.
    """
    def ids_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, each, decoded in _encoded(batches, ByteBPE(rank_file, pattern)):
            yield pa.RecordBatch.from_arrays([own, pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32())),
                                              pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    def digests_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBPE(rank_file, pattern)
        for own, each, decoded in _encoded(batches, bpe):
            yield pa.RecordBatch.from_arrays([
                own, pa.array(map(len, each), pa.int64()),
                pa.array([hashlib.sha256(bpe.decimal_text(x)).hexdigest() for x in each], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    if digests:
        return slim.mapInArrow(digests_out, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return slim.mapInArrow(ids_out, "doc_id long, ids array<int>, decoded binary")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded by the multilingual byte-level ranks.

    An empty or null text has no ids and the digests of nothing.
    """
    import public_tokenizers

    return encode_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)

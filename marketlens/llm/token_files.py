"""Operator 5: token-id files by an adaptive context-mixing range coder.

Ids are cut into blocks that are reset, coded and checksummed by themselves. In a block three predictors work together: the id
that last followed the two ids before (order 2), the one that last followed the id before (order 1), and adaptive counts of
id groups (order 0). Their predictions are mixed linearly: order 2 gets the share of the unit interval that its hits so far
with the same confidence have earned, order 1 its earned share of the rest (both meet in one slice where they agree),
order 0 what remains. One range-coder step codes the slice, and within order 0 the group and the place in the group.
All blocks of a segment are coded in step with each other, as lanes of numpy arrays.

Files are Parquet, so that Spark's commit protocol makes them whole: a row is a segment of documents, with the documents'
ids and lengths, the blocks' lengths, sizes and checksums, and the coded bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import library_chunks, read_table, starts, text_slices
from marketlens.session import scratch_path

BLOCK_IDS = 2048
# All blocks of a segment are coded in step: the more there are, the less each numpy call costs an id.
SEGMENT_IDS = 8_000_000
MOST_ID = 2**18 - 2

# Slots of the two context tables, the 16-bit scale of shares, and the bounds of a learned share.
SLOTS_1, SLOTS_2 = 1024, 2048
SCALE, FLOOR = 65536, 2048
# Groups of ids on a logarithmic scale: two for each bit length of id + 1.
N_GROUPS, GROUP_STEP, GROUP_LIMIT = 38, 24, 8192

U64 = np.uint64
# Below these, the top 16 bits of low and of low plus range are equal, or the range is too short to go on.
TOP, SHORT = U64(1 << 48), U64(1 << 47)
# The confidence after a hit, by the one before, at its place in a slot.
NEXT_CONF = np.array([1, 2, 3, 3, 0], np.int64) << 20


def _group(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, first id and size (as a power of 2) of the group of each id."""
    v = ids.astype(np.int64) + 1
    e = np.frexp(v.astype(np.float64))[1].astype(np.int64) - 1
    power = np.maximum(e - 1, 0)
    half = np.where(e > 0, (v >> power) & 1, 0)
    base = np.where(e > 0, (2 + half) << power, 1) - 1
    return 2 * e + half, base, power.astype(U64)


class _Lanes:
    """Model and coder state of a set of blocks that are coded in step; encoder and decoder share every update.

    Every update works on whole arrays of lanes: a lane to which it does not apply gets a neutral value, which costs less than
    picking the others out. Ids are held plus 1, so that 0 is no id.
    """

    PER_LANE = ("lane", "at1", "at2", "at_p", "a", "b", "low", "range")

    def __init__(self, n: int) -> None:
        self.n = n
        self.lane = np.arange(n, dtype=np.int64)
        self.at1, self.at2, self.at_p = self.lane * SLOTS_1, self.lane * SLOTS_2, self.lane * 5
        self.seen1 = np.full(n * SLOTS_1, 4 << 20, np.int32)  # id + 1, and its confidence from bit 20 on (4: none seen)
        self.seen2 = np.full(n * SLOTS_2, 4 << 20, np.int32)
        self.share1 = np.full((n, 5), SCALE // 4, np.int64)  # by confidence; nothing for none seen
        self.share2 = np.full((n, 5), SCALE // 2, np.int64)
        self.share1[:, 4] = self.share2[:, 4] = 0
        # Sums of the counts of the groups before each, one column a lane.
        self.cum = np.repeat(np.arange(N_GROUPS + 1, dtype=np.uint16)[:, None], n, axis=1)
        self.all_cum = self.cum.reshape(-1)
        self.all_groups = np.arange(N_GROUPS + 1, dtype=np.uint8)[:, None]
        self.a = np.zeros(n, np.int64)
        self.b = np.zeros(n, np.int64)
        self.low = np.zeros(n, U64)
        self.range = np.full(n, 2**64 - 1, U64)

    def keep(self, n: int) -> None:
        """Go on with the first n lanes alone."""
        for name in self.PER_LANE:
            setattr(self, name, getattr(self, name)[:n])
        self.cum = self.cum[:, :n]

    def predict(self) -> None:
        """Predictions and slices for the next id of each lane."""
        h = self.a * 40503
        self.slot1 = (h >> 6) & (SLOTS_1 - 1)
        self.slot1 += self.at1
        h += self.b * 30011
        h >>= 5
        h &= SLOTS_2 - 1
        h += self.at2
        self.slot2 = h
        s1, s2 = self.seen1.take(self.slot1).astype(np.int64), self.seen2.take(self.slot2).astype(np.int64)
        self.guess1, self.guess2 = s1 & 0xFFFFF, s2 & 0xFFFFF
        s1 >>= 20
        s2 >>= 20
        self.conf1, self.conf2 = s1, s2
        self.p1, self.p2 = s1 + self.at_p, s2 + self.at_p
        self.old1, self.old2 = self.share1.take(self.p1), self.share2.take(self.p2)
        f1 = SCALE - self.old2
        f1 *= self.old1
        f1 >>= 16
        self.f12 = f1 + self.old2
        f1 *= self.guess1 == self.guess2
        f1 += self.old2
        self.f2 = f1

    def narrow_guess(self, part: np.ndarray, in2: np.ndarray, in1: np.ndarray) -> np.ndarray:
        """Keep the slice of the order (``in2`` before ``in1``); ``part`` is what one unit of the scale takes of the range. How far low moved."""
        low = np.where(in2, 0, np.where(in1, self.f2, self.f12))
        size = np.where(in2, self.f2, np.where(in1, self.f12, SCALE))
        size -= low
        moved = part * low.view(U64)
        self.low += moved
        np.multiply(part, size.view(U64), out=self.range)
        return moved

    def narrow_group(self, part: np.ndarray, group: np.ndarray, miss: np.ndarray) -> np.ndarray:
        """Keep the slice of the group where both guesses missed, and count the group. How far low moved."""
        at = group * self.n
        at += self.lane
        low = self.all_cum.take(at)
        at += self.n * miss
        size = self.all_cum.take(at) - low
        size += ~miss
        low = (low * miss).astype(U64)
        low *= part
        self.low += low
        np.multiply(part, size, out=self.range)
        raised = self.all_groups > group.astype(np.uint8)
        self.cum += (raised.view(np.uint8) * np.uint8(GROUP_STEP)).astype(np.uint16)
        if (full := np.flatnonzero(self.cum[-1] > GROUP_LIMIT)).size:
            halved = (np.diff(self.cum[:, full].astype(np.int64), axis=0) + 1) >> 1
            self.cum[1:, full] = np.cumsum(halved, axis=0)
        return low

    def totals(self, miss: np.ndarray) -> np.ndarray:
        """Sum of the counts of the groups where both guesses missed, else 1."""
        return np.where(miss, self.cum[-1], np.uint16(1)).astype(U64)

    def learn(self, ids: np.ndarray) -> None:
        """``ids`` (plus 1) are the next ones."""
        for guess, conf, p, old, share, seen, slot in ((self.guess1, self.conf1, self.p1, self.old1, self.share1, self.seen1, self.slot1),
                                                       (self.guess2, self.conf2, self.p2, self.old2, self.share2, self.seen2, self.slot2)):
            hit = guess == ids
            new = np.where(hit, SCALE - FLOOR, FLOOR)
            new -= old
            new >>= 4
            new += old
            share.reshape(-1)[p] = new
            share[:, 4] = 0
            sure = NEXT_CONF.take(conf)
            sure *= hit
            sure += ids
            seen[slot] = sure
        self.b = self.a
        self.a = ids

    def settled(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lanes whose top 16 bits are settled, and their low, again and again; the caller moves those bits out or in."""
        rows = np.flatnonzero(((self.low ^ (self.low + self.range)) < TOP) | (self.range < SHORT))
        low, span = self.low[rows], self.range[rows]
        while len(rows):
            span = np.where((low ^ (low + span)) < TOP, span, (U64(0) - low) & (SHORT - U64(1)))
            yield rows, low
            low <<= U64(16)
            span <<= U64(16)
            self.low[rows] = low
            self.range[rows] = span
            more = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < SHORT))
            rows, low, span = rows[more], low[more], span[more]


def encode_blocks(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[bytes, np.ndarray]:
    """Coded bytes of all blocks end to end, and each block's number of bytes."""
    n_blocks = -(-len(ids) // block_ids)
    if not n_blocks:
        return b"", np.zeros(0, np.int64)
    if int(ids.max()) > MOST_ID:
        raise ValueError(f"ids above {MOST_ID} do not fit this format")
    grid = np.zeros((n_blocks, block_ids), np.uint32)
    grid.reshape(-1)[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.T)
    last = len(ids) - (n_blocks - 1) * block_ids
    group_of = _group(np.arange(int(ids.max()) + 1))[0].astype(np.uint8)
    base_of, power_of = _group_tables()
    m = _Lanes(n_blocks)
    width = 3 * block_ids + 8
    out = np.empty(n_blocks * width, np.uint16)
    first = np.arange(n_blocks) * width
    end = first.copy()
    for t in range(block_ids if n_blocks > 1 else last):
        if t == last:
            m.keep(n_blocks - 1)
        x = grid[t, : len(m.lane)].astype(np.int64)
        y = x + 1
        m.predict()
        in2, in1 = m.guess2 == y, m.guess1 == y
        miss = ~(in2 | in1)
        m.narrow_guess(m.range >> U64(16), in2, in1)
        group = np.where(miss, group_of.take(x), np.uint8(N_GROUPS)).astype(np.int64)
        m.narrow_group(m.range // m.totals(miss), group, miss)
        # The place in the group; a guess that hit takes what there is.
        x -= base_of.take(group)
        x *= miss
        m.range >>= power_of.take(group)
        m.low += m.range * x.view(U64)
        m.learn(y)
        for rows, low in m.settled():
            at = end[rows]
            out[at] = low >> U64(48)
            at += 1
            end[rows] = at
        if t == last - 1:
            final = m.low[-1]
    lows = np.append(m.low, final) if len(m.lane) < n_blocks else m.low
    for shift in (48, 32, 16, 0):
        out[end] = (lows >> U64(shift)) & U64(0xFFFF)
        end += 1
    payload = b"".join(out[a:b].astype("<u2").tobytes() for a, b in zip(first.tolist(), end.tolist(), strict=True))
    return payload, (end - first) * 2


def decode_blocks(payload: bytes, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of all blocks end to end. All blocks but the last must have the same length."""
    n_blocks = len(sizes)
    if not n_blocks:
        return np.zeros(0, np.uint32)
    block_ids, last = int(lengths[0]), int(lengths[-1])
    words = np.concatenate([np.frombuffer(payload, "<u2"), np.zeros(8, "<u2")])
    at = starts(sizes // 2)[:-1]
    ahead = np.zeros(n_blocks, U64)  # the code less low
    for _ in range(4):
        ahead = ahead << U64(16) | words[at]
        at += 1
    out = np.zeros((block_ids, n_blocks), np.uint32)
    base_of, power_of = _group_tables()
    m = _Lanes(n_blocks)
    for t in range(block_ids):
        if t == last:
            m.keep(n_blocks - 1)
            ahead = ahead[: n_blocks - 1]
        m.predict()
        part = m.range >> U64(16)
        value = (ahead // part).view(np.int64)
        in2, in12 = value < m.f2, value < m.f12
        y = np.where(in2, m.guess2, m.guess1)
        miss = ~in12
        ahead -= m.narrow_guess(part, in2, in12)
        totals = m.totals(miss)
        part = m.range // totals
        value = np.minimum(ahead // part, totals - U64(1)).astype(np.uint16)
        value[in12] = 0xFFFF
        group = np.add.reduce((m.cum <= value).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64) - 1
        ahead -= m.narrow_group(part, group, miss)
        m.range >>= power_of.take(group)
        place = ahead // m.range
        place *= miss
        moved = place * m.range
        m.low += moved
        ahead -= moved
        y = np.where(miss, base_of.take(group) + place.view(np.int64) + 1, y)
        m.learn(y)
        out[t, : len(y)] = y - 1
        for rows, _low in m.settled():
            k = at[rows]
            ahead[rows] = ahead[rows] << U64(16) | words[k]
            k += 1
            at[rows] = k
    return out.T.reshape(-1)[: (n_blocks - 1) * block_ids + last]


def _group_tables() -> tuple[np.ndarray, np.ndarray]:
    """First id and power of 2 of the size of each group, and zeros for no group."""
    firsts = np.array([0, *(((2 + h) << (e - 1)) - 1 for e in range(1, N_GROUPS // 2) for h in (0, 1))])
    group, base, power = _group(firsts)
    base_of, power_of = np.zeros(N_GROUPS + 1, np.int64), np.zeros(N_GROUPS + 1, U64)
    base_of[group], power_of[group] = base, power
    return base_of, power_of


SEGMENTS = pa.schema([("part", pa.int32()), ("start_in_part", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_lengths", pa.list_(pa.int64())), ("block_lengths", pa.list_(pa.int32())),
                      ("block_sizes", pa.list_(pa.int32())), ("coded_crc32", pa.list_(pa.int64())),
                      ("block_crc32", pa.list_(pa.int64())), ("payload", pa.binary())])
SEGMENTS_DDL = ("part int, start_in_part long, doc_ids array<long>, doc_lengths array<long>, block_lengths array<int>, "
                "block_sizes array<int>, coded_crc32 array<long>, block_crc32 array<long>, payload binary")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _coded_crcs(payload: bytes, sizes: np.ndarray) -> list[int]:
    view, edges = memoryview(payload), starts(sizes).tolist()
    return [zlib.crc32(view[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def segment_row(part: int, start: int, doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row of the file format."""
    payload, sizes = encode_blocks(ids)
    cuts = [*range(0, len(ids), BLOCK_IDS), len(ids)] if len(ids) else [0]
    blocks = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    columns = [part, start, doc_ids, lengths.tolist(), [len(b) for b in blocks], sizes.tolist(), _coded_crcs(payload, sizes),
               [_crc(b) for b in blocks], payload]
    return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, SEGMENTS, strict=True)], schema=SEGMENTS)


def write_files(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text", added_tokens: bool = False) -> None:
    """Encode the documents, append ``end_id`` to each, and write the ids in ascending id order to ``path``.

    A null text counts as empty (its ids are the end id alone); a null id comes first; rows with the same id are
    ordered by a hash of their text, so that many of them are several ranges. Documents are dealt by ranges of the id, so a file holds a stretch of the order. ``added_tokens`` as in
    ``library_chunks``.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_chunks(tokenizer_file, added_tokens=added_tokens)
        part, start = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        waiting: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        for rows, texts in text_slices(batches):
            ids, offsets = encoder(texts)
            # The end id goes in after each document's own ids.
            full = np.insert(ids, offsets[1:], np.uint32(end_id)) if len(texts) else ids
            doc_ids += rows.column(0).to_pylist()
            waiting.append(full)
            lengths.append(np.diff(offsets) + 1)
            if sum(map(len, waiting)) >= SEGMENT_IDS:
                all_ids = np.concatenate(waiting)
                yield segment_row(part, start, doc_ids, np.concatenate(lengths), all_ids)
                start += len(all_ids)
                doc_ids, waiting, lengths = [], [], []
        if doc_ids:
            yield segment_row(part, start, doc_ids, np.concatenate(lengths), np.concatenate(waiting))

    # Ranges are cut by a sample of their keys, which comes to the driver: a hash stands for the text in it.
    (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text", f"xxhash64(cast(`{text_col}` as string)) as hash")
     .repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
     .mapInArrow(run, SEGMENTS_DDL).write.mode("errorifexists").parquet(path))


def read_files(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids before it in all files), ``n_tokens`` and ``ids``, or with ``digests`` ``ids_crc32``.

    Every block's checksums (of its coded bytes and of its ids) are compared; a difference raises an error that names the block.
    """
    files = spark.read.schema(SEGMENTS_DDL).parquet(path)
    # One row a part: their number is that of the partitions written, whatever the documents.
    sizes = files.groupBy("part").agg(F.sum(F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["block_lengths"], np.int64)
                coded = _coded_crcs(row["payload"], np.array(row["block_sizes"], np.int64))
                if bad := [k for k, (x, y) in enumerate(zip(coded, row["coded_crc32"], strict=True)) if x != y]:
                    raise ValueError(f"blocks {bad} of the segment at {row['start']} are damaged")
                ids = decode_blocks(row["payload"], np.array(row["block_sizes"], np.int64), lengths)
                edges = starts(lengths)
                for k, crc in enumerate(row["block_crc32"]):
                    if _crc(ids[edges[k]:edges[k + 1]]) != crc:
                        raise ValueError(f"block {k} of the segment at {row['start']} is damaged: its ids have another checksum")
                own = starts(np.array(row["doc_lengths"], np.int64))
                each = [ids[a:b] for a, b in zip(own, own[1:], strict=False)]
                last = pa.array([_crc(x) for x in each], pa.int64()) if digests else pa.array(each, pa.list_(pa.uint32())).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(own[:-1] + row["start"]), pa.array(np.diff(own)), last],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"])

    # A row for each part written: joined by a hint, as a shuffle would move all coded bytes.
    return (files.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("start_in_part"))
            .select("start", "doc_ids", "doc_lengths", "block_lengths", "block_sizes", "coded_crc32", "block_crc32", "payload")
            .mapInArrow(run, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digests else 'ids array<int>'}"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as range-coded token files in the shared folder, and what the files hold, read back."""
    import public_tokenizers

    path = scratch_path(spark, "op5-token-files")
    write_files(read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), path, added_tokens=True)
    return read_files(spark, path, digests=True)

"""Operators 3, 5 and 10: exact against the libraries, round trips, packing under every constraint."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlens.llm import byte_bpe, packing, token_files
from marketlens.llm.byte_bpe import ByteBPE, RankBitmap
from marketlens.llm.common import library_chunks, space_chunk_keys, space_chunks, starts

from .helpers import empty_docs, odd_docs, odd_texts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


def test_bitmap_finds_the_smallest_rank():
    bits, there = RankBitmap(), set()
    rng = np.random.default_rng(1)
    for r in rng.integers(0, 50_000, 3000).tolist():
        (bits.add if r % 3 else bits.remove)(r)
        (there.add if r % 3 else there.discard)(r)
        assert bits.first() == min(there, default=-1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abeinrst \n'é漢🙂0A", max_size=60), max_size=6))
def test_byte_bpe_equals_tiktoken(bpe, tik, texts):
    ids, lengths = bpe.encode_texts(texts)
    edges = starts(lengths)
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)] == [tik.encode_ordinary(t) for t in texts]


def test_byte_bpe_long_pretokens(bpe, tik):
    rng = np.random.default_rng(2)
    for text in ("a" * 20_001, "ab" * 9_000, "".join(rng.choice(list("aeinst"), 20_000)), " " * 5000, "🙂" * 3000):
        ids, _ = bpe.encode_texts([text])
        assert ids.tolist() == tik.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_byte_bpe_rows(spark, tik):
    docs = odd_docs(spark)
    got = byte_bpe.encode_documents(docs, RANKS, P.PATTERN).collect()
    assert len(got) == docs.count()
    want = sorted((str(r.doc_id), tik.encode_ordinary(r.text or "")) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert sorted(bytes(r.decoded) for r in got) == sorted((r.text or "").encode() for r in docs.collect())
    assert byte_bpe.encode_documents(empty_docs(spark), RANKS, P.PATTERN).collect() == []


def test_op3_against_brute_force(spark, tik):
    got = {r.doc_id: r for r in byte_bpe.op3_byte_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = tik.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@pytest.mark.parametrize(("name", "byte_level"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_library_ids(name, byte_level):
    texts = [t or "" for t in odd_texts()] + ["ΑΣ ΣΑΣ", "İI ı ẞ", "a\nb\nC", "\nA", "x \x1c y\x85z", "DON'T", "é É"]
    ids, offsets = library_chunks(P.path(name), byte_level)(texts)
    want = [library(name).encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == want


MARKED = ["one doc.<|endoftext|>next doc", "<|endoftext|>", " <|endoftext|>", "a <|endoftext|> b", "\n<|endoftext|>\n", "<|startoftext|>A b<|endoftext|>",
          "<|ENDOFTEXT|> Up", "<|endoftext|><|endoftext|> x", "<|endof text|>", "<|endoftext|", "漢<|endoftext|>Σ İ", "  <|endoftext|>  x", "plain text"]


@pytest.mark.parametrize(("name", "byte_level"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_ids_of_added_tokens(name, byte_level):
    texts = [*MARKED, *(t or "" for t in odd_texts()), *(" ".join(["Some", t, "End"]) for t in MARKED)]
    ids, offsets = library_chunks(P.path(name), byte_level, added_tokens=True)(texts)
    want = [Tokenizer.from_file(P.path(name)).encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == want
    assert len(want[0]) == 6


def test_queries_encode_added_tokens_as_the_library(spark, tmp_path):
    rows = list(enumerate([*MARKED, *odd_texts()]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    word, byte = (Tokenizer.from_file(P.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    ids = {d: [*byte.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op5_token_files(spark, str(tmp_path)).collect()}
    at = starts(np.array([len(ids[d]) for d, _ in rows])).tolist()
    assert got == {d: (at[d], len(ids[d]), zlib.crc32(np.array(ids[d], "<u4").tobytes())) for d, _ in rows}
    packed = {}
    for r in packing.op10_packing(spark, str(tmp_path)).collect():
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == {d: len(word.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in rows}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, token_files.MOST_ID), max_size=400), st.integers(1, 4), st.sampled_from([1, 7, 64, 2048]))
def test_range_coder_round_trip(ids, repeat, block):
    ids = np.array(ids * repeat, np.uint32)
    payload, sizes = token_files.encode_blocks(ids, block)
    lengths = np.diff([*range(0, len(ids), block), len(ids)]) if len(ids) else np.zeros(0, int)
    assert len(payload) == sizes.sum()
    assert token_files.decode_blocks(payload, sizes, lengths).tolist() == ids.tolist()


def test_range_coder_adapts():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    payload, _ = token_files.encode_blocks(ids)
    assert len(payload) < len(ids) / 4  # two bits an id, where plain ids take 16


def test_range_coder_gives_order_1_its_share_beside_a_sure_order_2():
    # Both shares near their most: their product passes 2**31.
    ids = np.tile(np.random.default_rng(1).integers(0, 1000, 266).astype(np.uint32), 9)
    payload, sizes = token_files.encode_blocks(ids)
    assert len(payload) < 950
    assert token_files.decode_blocks(payload, sizes, np.array([2048, len(ids) - 2048])).tolist() == ids.tolist()


def test_texts_are_cut_into_different_chunks_once():
    texts = ["a b a b", "b\nb a", "", " ", "a", " a", "\nb", "a  b", "a\n", "a \x85", "a \u3000b", "é\u2028 b", "a<|e|>b a", "a\tb \x00", *(t or "" for t in odd_texts())]
    for whole in ((), ("<|e|>",)):
        keys, places, counts = space_chunk_keys(texts, whole)
        want = [space_chunks(t, whole) for t in texts]
        assert [keys[i] for i in places] == [c for own in want for c in own]
        assert counts.tolist() == list(map(len, want))
        inner = [k for k in keys if k[:1] != " "]
        assert len(inner) == len(set(inner))


def test_token_files_hold_all_documents_in_order(spark, tmp_path):
    docs = odd_docs(spark).repartition(3)
    token_files.write_files(docs, P.path("byte_bpe_50k.json"), str(tmp_path / "ids"))
    got = token_files.read_files(spark, str(tmp_path / "ids")).orderBy("start").collect()
    order = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    tok = library("byte_bpe_50k.json")
    want = [[*tok.encode(r.text or "", add_special_tokens=False).ids, 0] for r in order]
    assert [r.doc_id for r in got] == [r.doc_id for r in order]
    assert [r.ids for r in got] == want
    assert [r.start for r in got] == starts(np.array([len(w) for w in want]))[:-1].tolist()


def test_token_files_damage_is_noticed(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "ids")
    token_files.write_files(odd_docs(spark).coalesce(1), P.path("byte_bpe_50k.json"), path)
    spark.read.parquet(path).withColumn("payload", F.expr("overlay(payload PLACING X'FF00FF' FROM 40)")).write.parquet(path + "-bad")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_files(spark, path + "-bad", digests=True).collect()


def test_token_files_empty(spark, tmp_path):
    token_files.write_files(empty_docs(spark), P.path("byte_bpe_50k.json"), str(tmp_path / "none"))
    assert token_files.read_files(spark, str(tmp_path / "none")).collect() == []


def test_op5_against_the_library(spark):
    tok = library("byte_bpe_50k.json")
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    ids = [np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in rows]
    want = list(zip([r.doc_id for r in rows], starts(np.array([len(i) for i in ids]))[:-1].tolist(), map(len, ids),
                    [zlib.crc32(i.tobytes()) for i in ids], strict=True))
    assert sorted(map(tuple, token_files.op5_token_files(spark, SF).collect())) == want


def check_packing(rows, max_tokens):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end or r.length == 0
            end = max(end, r.offset + r.length)
        assert end <= max_tokens
    return by_sequence


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(spark, rule):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(n)) for i, n in enumerate(rng.integers(1, 700, 900))]
    pieces = spark.createDataFrame(rows, "doc_id long, length long")
    out = packing.pack(pieces, 1000, 5, 600_000, (1.0, 0.5, 0.5), rule, group_pieces=300).collect()
    assert sorted(r.doc_id for r in out) == list(range(900))
    for own in check_packing(out, 1000).values():
        assert len(own) <= 5 and sum(r.length**2 for r in own) <= 600_000


def test_packing_is_tight():
    rng = np.random.default_rng(4)
    n = np.minimum(4096, np.exp(rng.normal(6.5, 1, 4000)).astype(int) + 1).astype(float)
    out = packing.best_fit(np.stack([n, np.ones(4000), n**2], 1), np.array([4096, 4096, 4096.0**2]), np.array([1, 1e-6, 1e-6]))
    assert np.bincount(out, weights=n).max() <= 4096
    assert out.max() + 1 <= np.ceil(n.sum() / 4096) + 3


def test_packing_refuses_what_cannot_fit(spark):
    with pytest.raises(Exception, match="exceeds a capacity"):
        packing.pack(spark.createDataFrame([(1, 11)], "doc_id long, length long"), 10).collect()


def test_pieces_and_packing_of_odd_rows(spark):
    docs = odd_docs(spark)
    tok = library("word_bpe_49k.json")
    pieces = packing.tokenized_pieces(docs, P.path("word_bpe_49k.json"), max_tokens=512, with_ids=True)
    by_doc = {}
    for r in pieces.collect():
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault((r.doc_id, r.piece), r)
    for r in docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert [i for k in range(-(-len(ids) // 512)) for i in by_doc[r.doc_id, k].ids] == ids
    out = packing.pack(pieces.drop("ids").selectExpr("*", "'x' as sequence_id"), 512).collect()
    assert len(out) == pieces.count()
    check_packing(out, 512)
    none = packing.tokenized_pieces(empty_docs(spark), P.path("word_bpe_49k.json"))
    assert packing.pack(none).collect() == []


def test_op10_packs_all_tokens(spark):
    out = packing.op10_packing(spark, SF).collect()
    sequences = check_packing(out, 4096)
    tok = library("word_bpe_49k.json")
    docs = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for d, n in docs.items():
        own = sorted((r for r in out if r.doc_id == d), key=lambda r: r.piece)
        assert sum(r.length for r in own) == n and all(r.length == 4096 for r in own[:-1])
    assert len(sequences) <= -(-sum(docs.values()) // 4096) + 1

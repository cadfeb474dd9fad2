"""Operators 11 to 13: alignment of tokenizers, periodic runs and licence scans, each against brute force."""

from __future__ import annotations

import hashlib
import json
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction
from unittest.mock import MagicMock

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import license_scan, run_detection, token_alignment
from marketlens.llm.common import starts

from .helpers import empty_docs, odd_docs

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark, sf=SF):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# ------------------------------------------------------------------------------------------------ operator 12
def brute_runs(words):
    """(start, length, smallest period) of every run, straight from the definition."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j + p), p)  # the same stretch with a multiple of its period is no run of its own
            i = max(j, i) + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def brute_op12(doc_id, text):
    words = WORDS.findall((text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    keep = np.ones(n, bool)
    for a, length, p in runs:
        keep[a + p:a + length] = False
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for w, k in zip(words, keep, strict=True) if k)).hexdigest())


def test_transform_is_the_exact_convolution():
    rng = np.random.default_rng(3)
    x, y = (rng.integers(0, run_detection.PRIME, (16, 5)).astype(np.uint64) for _ in range(2))
    back = run_detection.inverse_transform(run_detection.transform(x.copy()))
    assert (back == x).all()
    product = run_detection.inverse_transform(run_detection.transform(x.copy()) * run_detection.transform(y.copy()) % np.uint64(run_detection.PRIME))
    for c in range(5):
        want = [sum(int(x[i, c]) * int(y[(k - i) % 16, c]) for i in range(16)) % run_detection.PRIME for k in range(16)]
        assert product[:, c].tolist() == want


def test_runs_of_random_words_equal_brute_force():
    random.seed(5)
    for _ in range(150):
        docs = []
        for _ in range(random.randint(1, 5)):
            n, v = random.randint(0, 130), random.choice([1, 2, 2, 3, 40])
            own = [random.randrange(v) for _ in range(n)]
            if n > 8 and random.random() < 0.7:
                a = random.randrange(n)
                p = random.randint(1, max(1, (n - a) // 3))
                own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]
            docs += [own] * random.choice([1, 1, 2])  # a run must not go on into an equal neighbour
        offsets = starts(np.array([len(d) for d in docs], np.int64))
        got = run_detection.periodic_runs(np.array([w for d in docs for w in d], np.int64), offsets)
        want = [(a + int(offsets[i]), a + b + int(offsets[i]), p) for i, d in enumerate(docs) for a, b, p in brute_runs(d)]
        assert [tuple(r) for r in got.tolist()] == sorted(want, key=lambda r: (r[0], r[2]))


def test_long_texts_of_one_word_and_of_long_periods():
    words = np.concatenate([np.zeros(50_000, np.int64), [9], np.tile(np.random.default_rng(1).integers(0, 2, 7_001), 5)])
    got = {tuple(r) for r in run_detection.periodic_runs(words, np.array([0, len(words)])).tolist()}
    assert (0, 50_000, 1) in got
    assert any(p == 7_001 and e == len(words) for _, e, p in got)


def test_op12_equals_brute_force(spark):
    docs = documents(spark)
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in run_detection.op12_run_detection(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for doc_id, text in docs.items():
        assert got[doc_id] == brute_op12(doc_id, text), doc_id
    assert sum(v[0] > 0 for v in got.values()) > len(got) / 20


def test_runs_of_odd_rows(spark):
    more = [(50 + i, t) for i, t in enumerate(["a b " * 40, "x " * 5, "x " * 6, "\x0b\x0ca\ta\ra\na a  a", "é " * 9 + "    \x85", "a " * 200_000])]
    docs = odd_docs(spark, more)
    rows = run_detection.detect_runs(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in docs.select("doc_id", "text").collect():
        words = WORDS.findall((r.text or "").encode())
        if len(words) < 1_000:
            assert [tuple(x) for x in by_id[r.doc_id].runs] == brute_runs(words)
            assert by_id[r.doc_id].n_words == len(words)
    assert [tuple(x) for x in by_id[50].runs] == [(0, 80, 2)] and by_id[50].collapsed == "a b"
    assert by_id[51].runs == [] and [tuple(x) for x in by_id[52].runs] == [(0, 6, 1)]
    assert [tuple(x) for x in by_id[55].runs] == [(0, 200_000, 1)] and by_id[55].collapsed == "a"
    assert run_detection.detect_runs(empty_docs(spark)).count() == 0
    assert run_detection.repeated_tails(empty_docs(spark)).count() == 0
    assert run_detection.repeated_tails(docs).count() == len(rows)


# ------------------------------------------------------------------------------------------------ operator 13
def brute_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = [(i, label) for phrase, label in license_scan.BASE_PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


BASE_SQL = """
WITH cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrases(words, label) AS (VALUES {phrases}),
places AS (SELECT doc_id, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(words)] = words)) AS word, label FROM cut, phrases)
SELECT cut.doc_id, len(any_value(w)) AS n_words, count(word) AS n_base, min(word) AS first_word, max(word) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM cut LEFT JOIN places USING (doc_id) GROUP BY cut.doc_id ORDER BY 1
"""


def test_expressions():
    parse = license_scan.parse_expression
    assert parse("MIT") == (["mit"], 0.1, 3)
    assert parse("MIT OR GPL-2.0-only AND CC-BY-NC-4.0")[1] == 0.1  # and before or
    assert parse("(MIT OR GPL-2.0-only) AND CC-BY-NC-4.0")[1] == 0.9
    assert parse("GPL-2.0-only WITH Classpath-exception-2.0 OR AGPL-3.0-only") == (["gpl", "agpl"], 0.4, 58)
    assert parse("GPL-3.0+ and more") == (["gpl"], 0.7, 8)  # what is no licence ends it
    assert parse("gpl-2.0 and (mit or (apache-2.0 and isc))")[:2] == (["gpl", "mit", "apache", "isc"], 0.7)
    assert parse("MIT This file is")[0] == ["mit"] and parse("MIT) x")[2] == 3
    assert parse("LicenseRef-Ours") == ([license_scan.OWN_TERMS], 1.0, 15)
    for text in ("", "(MIT", "and MIT", "Foo", "WITH x", "()", "(" * 5_000):
        assert parse(text) is None
    deep = "(" * 2_000 + "MIT" + ")" * 2_000
    assert parse(deep) == (["mit"], 0.1, len(deep))


def test_phrases_and_tags_of_texts():
    texts = ["", "Licensed under CC BY-NC 4.0.", "/* SPDX-License-Identifier: (MIT OR GPL-2.0-only) */\nMIT License",
             "cc by cc by CC-BY", "gnu General  public, license. MIT\tlicense", "éMIT license MIT licenseé", "a\x00mit license\x7fapache license",
             "mit", "license mit license", 'License-Expression: "Apache-2.0"', "SPDX license identifier of the file", "x " * 100_000 + "apache license"]
    n, finds = license_scan.scan_texts(texts)
    for text, words, own in zip(texts, n, finds, strict=True):
        assert (words, sorted((f[2], f[1]) for f in own if f[0] == "base")) == brute_places(text)
    assert {(f[0], f[1]) for f in finds[1]} == {("base", "cc-by"), ("phrase", "cc-by-nc")}
    assert [f[:3] + f[4:] for f in finds[2]] == [("expression", "mit", 0, 0.1, "(MIT OR GPL-2.0-only)"), ("expression", "gpl", 0, 0.1, "(MIT OR GPL-2.0-only)"),
                                                 ("base", "mit", 9, 0.1, None)]
    assert [f[:2] for f in finds[9]] == [("expression", "apache")] and finds[10] == []


def test_op13_equals_sql_and_odd_rows(spark):
    got = license_scan.op13_license_scan(spark, SF)
    listed = ", ".join(f"({phrase.split()!r}, '{label}')" for phrase, label in license_scan.BASE_PHRASES.items())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(BASE_SQL.format(phrases=listed)).fetchall()
    rows = got.orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == want
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.first_word is None) == (r.n_base == 0)
    docs = odd_docs(spark, [(90, "MIT license and Apache License")])
    odd = {r.doc_id: r for r in license_scan.scan_documents(docs).collect()}
    assert license_scan.scan_documents(docs).count() == docs.count()
    assert odd[0].n_words == 0 and odd[0].finds == [] and [f.label for f in odd[90].finds] == ["mit", "apache"]
    assert license_scan.scan_documents(empty_docs(spark)).count() == 0


# ------------------------------------------------------------------------------------------------ operator 11
def vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    value = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    entries = json.load(open(path("byte_bpe_50k.json")))["model"]["vocab"]
    a_bytes = {i: bytes(value[c] for c in t) for t, i in entries.items() if all(c in value for c in t)}
    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))

    def b_bytes(i):
        t = model.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if re.fullmatch("<0x..>", t) else t.replace("▁", " ").encode()

    return tokenizer, a_bytes, model, b_bytes


def brute_groups(text, tools):
    """[(ids of A, ids of B), ...] of a text, or [] without tokens."""
    tokenizer, a_bytes, model, b_bytes = tools
    if not text:
        return []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    if not b"".join(map(a_bytes.get, a)) == (" " + text).encode() == b"".join(map(b_bytes, b)):
        return []
    ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((a_bytes.get, a), (b_bytes, b))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    where = [np.searchsorted(cuts, e) for e in ends]
    groups = [([], []) for _ in cuts]
    for side, ids in ((0, a), (1, b)):
        for g, i in zip(where[side], ids, strict=True):
            groups[g][side].append(i)
    return groups


def brute_op11(docs):
    tools = vocabularies()
    groups = {k: brute_groups(t, tools) for k, t in docs.items()}
    links = {k: Counter((x, y) for a, b in own for x in a for y in b) for k, own in groups.items()}
    counts = Counter(pair for own in links.values() for pair in own)
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = {}
    for k, own in groups.items():
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out[k] = (sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(links[k].values()),
                  sum(n for p, n in links[k].items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in links[k].items()),
                  hashlib.sha256(text.encode()).hexdigest() if own else "")
    return out


ODD = ["a", " a", "\n\n", " ", "x▁y", "tab\tand\r\nline", "  two  spaces ", "<|endoftext|> is <s> text </s>", "Ünï çödé 漢字 🙂 ɐ", "<0x41> <unk>", "a\r\nb",
       "\r\n", "\ta\n b", "ends\n", "　x", "a b", "=" * 3_000, "漢" * 500, "aé́" * 40, "\x00\x01", "one two three", "one two three", "ﬁ ½"]


def figures(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}


def test_op11_equals_brute_force(spark):
    assert figures(token_alignment.op11_token_alignment(spark, SF).collect()) == brute_op11(documents(spark))


def test_alignment_of_odd_rows(spark, tmp_path):
    docs = odd_docs(spark, [(100 + i, t) for i, t in enumerate(ODD)])
    path = public_tokenizers.path
    base = token_alignment.write_alignments(docs, str(tmp_path / "odd"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    got = token_alignment.document_links(spark, str(tmp_path / "odd"), base).collect()
    assert len(got) == docs.count()
    # Rows that share an id count as documents of their own.
    texts = {(r.doc_id, k): r.text for k, r in enumerate(docs.select("doc_id", "text").collect())}
    want = Counter((k[0], *v) for k, v in brute_op11(texts).items())
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == want
    empty = token_alignment.write_alignments(empty_docs(spark), str(tmp_path / "none"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    assert token_alignment.document_links(spark, str(tmp_path / "none"), empty).count() == 0


def test_overlaps_and_groups_of_documents(spark):
    path = public_tokenizers.path
    docs = spark.createDataFrame(list(enumerate([*ODD, None, ""])), "doc_id long, text string")
    tools = vocabularies()
    for r in token_alignment.align_documents(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model")).collect():
        want = brute_groups([*ODD, None, ""][r.doc_id], tools)
        assert (r.a, r.b) == ([i for a, _ in want for i in a], [i for _, b in want for i in b])
        assert [(g.a, g.b) for g in r.groups] == list(zip(starts(np.array([len(a) for a, _ in want], np.int64))[:-1].tolist(),
                                                          starts(np.array([len(b) for _, b in want], np.int64))[:-1].tolist(), strict=True))
        ends = [np.cumsum([len(f(i)) for i in ids]) for f, ids in ((tools[1].get, r.a), (tools[3], r.b))]
        begins = [e - [len(f(i)) for i in ids] for e, f, ids in zip(ends, (tools[1].get, tools[3]), (r.a, r.b), strict=True)]
        assert [(o.a, o.b) for o in r.overlaps] == [(i, j) for i in range(len(r.a)) for j in range(len(r.b))
                                                    if begins[0][i] < ends[1][j] and begins[1][j] < ends[0][i]]


def test_large_groups_are_paired_by_distinct_ids():
    class Side:
        def __init__(self, ids, widths):
            self.ids, self.bytes = np.array(ids, np.uint32), np.frombuffer(b"x" * sum(widths), np.uint8)
            self.offsets = starts(np.array(widths, np.int64))

        def encode(self, texts):
            return self.ids, np.array([len(self.ids)])

    # The ends of one side are odd, those of the other even, up to the last: one group of 202 x 201 tokens.
    random.seed(2)
    a, b = Side([0, *random.choices([1, 2], k=200), 0], [1, 2, 2]), Side(random.choices([0, 1], k=201), [2, 2])
    found = token_alignment.Alignment(a, b, ["x" * 402])
    assert found.whole.all() and found.groups.tolist() == [1] and 202 * 201 > token_alignment.LARGE_GROUP
    codes, times, counts = found.links(10)
    assert len(codes) == counts.sum() == 6
    assert dict(zip(codes.tolist(), times.tolist(), strict=True)) == Counter(int(x) * 10 + int(y) for x in a.ids for y in b.ids)


def worker_run(monkeypatch):
    """The function of ``write_alignments`` that runs in the workers."""
    docs, context = MagicMock(), MagicMock()
    context.get.return_value.partitionId.return_value = 0
    monkeypatch.setattr(token_alignment, "TaskContext", context)
    token_alignment.write_alignments(docs, "unused", public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return docs.selectExpr.return_value.mapInArrow.call_args.args[0]


def test_a_worker_stays_small_and_its_rows_too(monkeypatch):
    run, rng = worker_run(monkeypatch), random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(150)) for _ in range(3_500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    list(run([batch.slice(0, 10)]))
    tracemalloc.start()
    links = size = 0
    for row in run([batch]):
        links += sum(row.column("n_distinct")[0].as_py())
        size += sum(len(row.column(c)[0].as_py()) for c in ("links", "times"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000_000 and size < 4 * links


def test_parts_hold_every_text():
    texts = ["one two three", "", "x" * 30, "two three", "", "", "three four five six", "y"]
    assert [list(p) for p in token_alignment.text_parts(texts, 20)] == [texts[:2], [texts[2]], texts[3:6], texts[6:]]
    assert list(token_alignment.text_parts([""])) == [[""]]


def test_links_are_counted_by_buckets():
    base, rng = 10, random.Random(4)
    entries = [(rng.randrange(30) * base + rng.randrange(base), rng.randint(1, 5)) for _ in range(400)]
    total, most = Counter(), Counter()
    for code, n in entries:
        total[code] += n
    for code, n in total.items():
        most[code // base] = max(most[code // base], n)
    codes, n_docs = (np.array(x) for x in zip(*entries, strict=True))
    got, best = token_alignment.counted_links(codes, n_docs, base)
    assert got.tolist() == [total[c] for c in codes.tolist()] and best.tolist() == [total[c] == most[c // base] for c in codes.tolist()]
    assert [len(x) for x in token_alignment.counted_links(codes[:0], n_docs[:0], base)] == [0, 0]
    parts = token_alignment.by_bucket(np.array([0, 0, 2]), np.array([5, 9, 7]), np.array([1, 2, 3], np.int32))
    assert [(p["bucket"], np.frombuffer(p["codes"], np.int64).tolist(), np.frombuffer(p["n_docs"], np.int32).tolist()) for p in parts] == [
        (0, [5, 9], [1, 2]), (2, [7], [3])]

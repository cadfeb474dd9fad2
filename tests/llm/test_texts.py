"""Operators 2, 4, 6, 7 and the pipeline: held-out accuracy, brute force, round trips, odd rows."""

import collections
import datetime
import hashlib
import itertools
import math
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlens.llm import language_id, lm_scoring, minhash, pii
from marketlens.llm.common import held_out, written
from marketlens.llm.components import connected_components

from .helpers import LONG, empty_docs, odd_docs

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"


# Operator 2

def test_language_held_out_accuracy(spark):
    got = language_id.op2_language_id(spark, BIG).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def brute_features(text):
    words = re.sub(r"[\W\d_]+", " ", text.lower()).split()
    return sum(max(0, len(w) + 2 - n + 1) - (2 if n == 1 else 0) for w in words for n in (1, 2, 3))


def test_features_stay_within_their_text():
    texts = ["ab c", "", "12", "Ünï çödé", "x" * 5, "a-b  c\n"]
    buckets, offsets = language_id.features(texts)
    assert np.diff(offsets).tolist() == [brute_features(t) for t in texts]
    for t, a, b in zip(texts, offsets, offsets[1:], strict=False):
        assert sorted(buckets[a:b].tolist()) == sorted(language_id.features([t])[0].tolist())
    whole, parts = language_id.features(["ab cd ef gh"])[0], language_id.features(language_id._parts("ab cd ef gh", 5))[0]
    assert sorted(whole.tolist()) == sorted(parts.tolist())


def plain_buckets(text):
    """Counts of the hashed n-grams of a text, one at a time."""
    out, mask = collections.Counter(), 2**64 - 1
    for w in re.sub(r"[\W\d_]+", " ", text.lower()).split():
        codes = [32, *map(ord, w), 32]
        for n in (1, 2, 3):
            for i in range(len(codes) - n + 1):
                if n == 1 and codes[i] == 32:
                    continue
                mixed = 0
                for order, c in enumerate(codes[i:i + n], 1):
                    mixed = (mixed * 0x100000001B3 + c + order) & mask
                out[((mixed * 0x9E3779B97F4A7C15) & mask) >> (64 - language_id.BUCKET_BITS)] += 1
    return out


def test_op2_equals_plain_naive_bayes(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    features = {r.doc_id: plain_buckets(r.text) for r in rows}
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None]
    langs = sorted({r.lang for r in train})
    counts = {x: sum((features[r.doc_id] for r in train if r.lang == x), collections.Counter()) for x in langs}
    prior = {x: math.log(sum(r.lang == x for r in train) / len(train)) for x in langs}
    size = 2**language_id.BUCKET_BITS
    total = {x: sum(c.values()) + language_id.ALPHA * size for x, c in counts.items()}
    got = {r.doc_id: r for r in language_id.op2_language_id(spark, SF).collect()}
    assert got.keys() == features.keys()
    for doc_id, own in features.items():
        logs = {x: prior[x] + sum(n * math.log((counts[x][b] + language_id.ALPHA) / total[x]) for b, n in own.items()) for x in langs}
        best = max(langs, key=lambda x: logs[x])
        if not own:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0)
            continue
        post = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        assert got[doc_id].lang_pred == best and abs(got[doc_id].score - post) < 1e-3


def test_language_odd_rows(spark):
    docs = odd_docs(spark)
    model = language_id.train(language_id.training_rows(docs))
    out = language_id.predict(docs, model)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2, 3, 5))
    assert all(got[i].lang_pred in ("en", "fr") for i in (4, 6, 7, 8, None))
    none = language_id.train(empty_docs(spark))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(empty_docs(spark), model).collect() == []


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神对待。",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Hyvää päivää", "Привет", "你好", "qxzjk", "xqzv kjwq zzxk qqpw vbnm xcvk jhgf", "QWxhZGRpbjpvcGVuIHNlc2FtZQ dGhpcyBpcyBhIHRlc3Q",
    " ".join("".join(np.random.default_rng(8).choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(3000))]
CLEAN = ["Von.", "That it.", "the", "de la", "Des enberge die enver.", "Pachque çaneux et.", "Of anntre erthnd, thlyre to the.", "Osiebo | armici. |"]


def test_language_stage_rejects_foreign_and_noise(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    labelled = {r.doc_id for r in docs.collect()}
    new = [(10**9 + i, t, None, "new", len(t)) for i, t in enumerate([*FOREIGN, *CLEAN])]
    got = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(new, docs.schema)), BIG).collect()}
    assert labelled <= got
    assert got - labelled == {10**9 + len(FOREIGN) + i for i in range(len(CLEAN))}


# Operator 4

def classes(spark, texts, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, strict=True))
    return minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def brute_classes(spark, docs):
    """Connected components over all pairs that share a shingle, by exact weighted Jaccard similarity."""
    rows = docs.select("doc_id", "text").collect()
    idf = minhash.inverse_frequencies(*minhash.document_frequencies(docs.selectExpr("cast(doc_id as long) doc_id", "text")))
    sets = []
    for r in rows:
        words = (r.text or "").lower().split()
        grams = [" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        sets.append(collections.Counter(grams))
    weight = {}
    for g in {g for s in sets for g in s}:
        h, _, _, _ = minhash.shingles([g])
        weight[g] = float(idf[minhash._bucket(h)][0])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            having[g].append(i)
    for i, j in {p for own in having.values() for p in itertools.combinations(own, 2)}:
        every = sets[i].keys() | sets[j].keys()
        low = sum(weight[g] * min(sets[i][g], sets[j][g]) for g in every)
        high = sum(weight[g] * max(sets[i][g], sets[j][g]) for g in every)
        if low >= 0.8 * high:
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r.doc_id)
    return {d: min(own) for own in groups.values() for d in own}


@pytest.mark.parametrize("chunk", [128, 2])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    monkeypatch.setattr(minhash, "SLICE", chunk)
    monkeypatch.setattr(minhash, "SPLIT_ROWS", chunk)  # with 2, every band of three nodes or more is split over tasks
    monkeypatch.setattr(minhash, "SPLIT_SHARE", 0)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = minhash.op4_minhash_dedup(spark, SF).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(spark, docs)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_copies_chain_and_hot_group(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choice(vocabulary, 300).tolist()
    chain = []
    for k in range(4):  # each step replaces 6 words, 30 of 296 shingles: neighbours are alike, the ends are not
        words = base.copy()
        for p in range(6 * k):
            words[10 + 9 * p] = f"x{p}"
        chain.append(" ".join(words))
    hot = rng.choice(vocabulary, 300).tolist()
    copies = [" ".join([*hot[:-1], f"end{i}"]) for i in range(40)] + [" ".join(hot)] * 40
    other = [" ".join(rng.choice(vocabulary, 300)) for _ in range(20)]
    got = {r.doc_id: r.class_id for r in classes(spark, chain + copies + other)}
    assert [got[i] for i in range(4)] == [0] * 4
    assert {got[4 + i] for i in range(80)} == {4}
    assert all(got[84 + i] == 84 + i for i in range(20))


def test_near_duplicates_odd_rows(spark):
    docs = odd_docs(spark, [(50, LONG + " end"), (51, "A ROW without id")])
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.class_id, r.kept))
    assert all(by_id[i] == {(i, True)} for i in (0, 1, 2, 3, 4, 5, 6, 8))
    assert by_id[12] == {(11, False)} and by_id[11] == {(11, True)}
    assert by_id[50] == {(7, False)}
    assert by_id[None] == {(51, False)}
    assert minhash.near_duplicates(empty_docs(spark)).collect() == []


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(60)]
    base, other = " ".join(words), " ".join(reversed(words))
    rows = [(1, base, "a"), (1, base, "b"), (1, other, "c"), (2, base.upper(), "d"), (3, " ".join([*words[:-1], "end"]), "e"),  # two texts under id 1
            (None, base, "f"), (None, "no id at all here", "g"), (None, "no  id at all here", "h"), (4, None, "i"), (4, " ", "j"), (None, None, "k"),
            (9, "text of its own", "l"), (9, "text of its own", "l"), (8, "a repeated text under two ids", "m"), (7, "a repeated text under two ids", "n")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, node string")  # a clashing name
    got = minhash.representatives(docs)
    assert got.columns == docs.columns
    assert sorted(r.node for r in got.collect()) == list("achijkln")  # h: two spaces come before one
    plain = docs.where("node in ('d', 'e', 'l')").dropDuplicates()  # no repeated rows: the other branch
    assert sorted(r.node for r in minhash.representatives(plain).collect()) == ["d", "l"]
    assert minhash.representatives(docs.limit(0)).collect() == []


def shuffled_rows(node):
    """Rows that the shuffles of an executed plan have written."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return shuffled_rows(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return shuffled_rows(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_rows(node.children().apply(i)) for i in range(node.children().size()))


def test_texts_in_no_group_are_not_shuffled(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(900)], 12)) for _ in range(300)]
    docs = spark.createDataFrame([*enumerate(texts), (300, texts[7].upper()), (301, None)], "doc_id long, text string")
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = minhash.representatives(docs)
        assert sorted(r.doc_id for r in got.collect()) == [*range(300), 301]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    assert 0 < shuffled_rows(got._jdf.queryExecution().executedPlan()) < 20  # the group's rows, not all 302


def python_nodes_together(df):
    """Python nodes of a plan that get rows from another one without a shuffle between: a task then runs both workers at once."""
    above, together = [], 0
    for line in df._jdf.queryExecution().sparkPlan().toString().splitlines():
        depth, name = re.match(r"[ :+-]*", line).end(), line.lstrip(" :+-")
        above = [a for a in above if a[0] < depth]
        kind = "python" if re.match(r"(Python)?Map(InArrow|InPandas)|FlatMap\w*Groups|ArrowEvalPython|BatchEvalPython", name) else None
        if kind is None and re.match(r"Sort ?Aggregate|HashAggregate|ObjectHashAggregate|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|Exchange|Repartition", name):
            kind = "other"
        # Joins and aggregates shuffle their rows, whatever else is between.
        together += kind == "python" and bool(near := [a for a in above if a[1]]) and near[-1][1] == "python"
        above.append((depth, kind))
    return together


def test_no_task_of_the_pipeline_runs_two_python_workers(spark, monkeypatch):
    found = []

    def noted(df, name):
        found.append((name, python_nodes_together(df)))
        return written(df, name)

    twice = spark.range(3).mapInArrow(lambda b: b, "id long")
    assert [python_nodes_together(x) for x in (twice, twice.mapInArrow(lambda b: b, "id long"))] == [0, 1]
    monkeypatch.setattr(minhash, "written", noted)
    monkeypatch.setattr(corpus_pipeline, "written", noted)
    docs = odd_docs(spark, [(50, LONG + " end")])
    for name, stage in corpus_pipeline.STAGES:
        docs = noted(stage(spark, docs, SF), name)
    assert {"minhash-shingles", "minhash-sketches", "pipeline-pieces", "packing"} <= {n for n, _ in found}
    assert [n for n, k in found if k] == []


def test_shingles_are_of_the_text_with_the_words_of_the_node(spark):
    texts = ["one two three four five six", "other words", "", None, "A  b\nC"]
    keys = minhash.shingles([t or "" for t in texts])[3]
    rows = [(keys[0], texts[0]), (keys[0], texts[1]), (keys[1], texts[2]), (keys[1], None), (keys[4], "a B c"), (None, "x")]
    got = minhash.packed_shingles(spark.createDataFrame(rows, "node binary, text string")).collect()
    assert sorted((bytes(r.node), len(r.packed)) for r in got) == sorted([(keys[0], 20), (keys[4], 10)])


def test_marks_hold_every_node_of_a_group(spark):
    rng = np.random.default_rng(9)
    nodes = [bytes(k) for k in rng.integers(0, 256, (500, 16), np.uint8)] + [b"\0" * 16, b"\xff" * 16, b"\0\0\7" + b"x" * 13, b"\0\x80\0" + b"x" * 13]
    marks = minhash.group_marks(spark.createDataFrame([(k,) for k in nodes], "node binary"))
    assert all(minhash.is_marked(marks, k) for k in nodes)
    assert int(np.unpackbits(marks).sum()) == len({k[:3] for k in nodes})


def test_pairs_of_a_block_that_cannot_be_alike_are_not_compared(monkeypatch):
    rng = np.random.default_rng(10)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(900)], 100)) for _ in range(40)]
    texts[30] = " ".join(["other", *texts[3].split()[1:]])
    hashes, counts, offsets, _ = minhash.shingles(texts)
    cut = list(zip(offsets, offsets[1:], strict=False))
    packed = [hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + counts[a:b].astype("<u4").tobytes() for a, b in cut]
    names = [b"%02d" % i for i in range(40)]
    rows = pa.table({"band": [7] * 80, "node": names * 2, "component": names * 2, "outer": [True] * 80, "asks": [True] * 40 + [False] * 40,
                     "packed": packed * 2, "bands": [[7, i] for i in range(40)] * 2})
    compared = []
    exact = minhash.weighted_jaccard
    monkeypatch.setattr(minhash, "weighted_jaccard", lambda x, y: compared.append(1) or exact(x, y))
    got = minhash.block_links(rows, np.ones(1 << minhash.BUCKET_BITS, np.float32), 0.8)
    assert got == [(b"03", b"30")]
    assert len(compared) == 1  # of 780 pairs


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_groups_are_whole_whatever_the_batches(size):
    keys = [(1, 0), (1, 0), (1, 1), (2, 0), (2, 0), (2, 0), (2, 0), (3, 1), (3, 2)]
    rows = pa.table({"a": [k[0] for k in keys], "b": [k[1] for k in keys], "n": range(9)})
    batches = [pa.RecordBatch.from_pylist([], rows.schema), *rows.to_batches(max_chunksize=size)]
    got = [t.column("n").to_pylist() for t in minhash._whole_groups(batches, ["a", "b"])]
    assert got == [[0, 1], [2], [3, 4, 5, 6], [7], [8]]
    assert list(minhash._whole_groups([], ["a", "b"])) == []


def test_samples_equal_their_definition():
    rng = np.random.default_rng(11)
    h, w = rng.integers(0, 2**44, 900).astype(np.uint64), (rng.random(900) * 5 + 0.1) * rng.choice([1e-6, 1, 1, 1e30], 900)
    h[300:600] = h[0]  # level ranks
    offsets = np.array([0, 300, 300, 600, 601, 900])
    sampler, u = minhash.Sampler(draws=12), np.uint64
    got = sampler.sketches(h, w, offsets, piece=64)
    for j, salt in enumerate(sampler.salts):
        x = h * salt
        x = (x ^ x >> u(32)) * u(0xD6E8FEB86659FD93)
        x ^= x >> u(29)
        r, beta, c = (table[(x >> u(k) & u(0xFFFF)).astype(int)] for k, table in ((0, sampler.r), (16, sampler.b), (32, sampler.log_c)))
        t = np.floor(np.log(w).astype(np.float32) * (1 / r) + beta)
        fixed = (np.maximum(c - r * (t - beta + np.float32(1)), np.float32(-95.9)) * np.float32(1 << 24) + np.float32(96 << 24)).astype(np.int64).view(u)
        sample = (x + t.astype(np.int64).view(u) * u(0x9E3779B97F4A7C15)) * u(0xFF51AFD7ED558CCD) >> u(32)
        every = fixed << u(32) | sample
        assert got[:, j].tolist() == [int(every[a:b].min() & u(0xFFFFFFFF)) if b > a else 0 for a, b in zip(offsets, offsets[1:], strict=False)]


def test_samples_agree_as_often_as_weighted_sets_are_alike():
    rng = np.random.default_rng(6)
    sampler = minhash.Sampler(draws=3000)
    h = np.sort(rng.integers(0, 2**44, 60).astype(np.uint64))
    w, v = rng.random(60) * 5 + 0.5, rng.random(60) * 5 + 0.5
    both = sampler.sketches(np.concatenate([h, h]), np.concatenate([w, v]), np.array([0, 60, 120]))
    assert abs((both[0] == both[1]).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum()) < 0.03


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(100, 200), (200, 150), (7, 7), (None, 3), (300, 301)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 150: 100, 200: 100, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# Operator 6

FOUND = {"email": "jo.do9@mail.example.org", "ipv4": "44.161.181.40", "card": "4111 1111-1111 1111".replace("-", " "), "phone": "+1 (755) 555-9729",
         "ssn": "123-45-6789", "date": "1987-02-28"}


def pseudonyms(spark, texts, key="k"):
    rows = pii.pseudonymize(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), key).orderBy("i").collect()
    return [r.text for r in rows], [r.n_pseudonyms for r in rows]


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_link(spark):
    texts = [f"a {v} b" for v in FOUND.values()] + [f"{v}, {v}; twice" for v in FOUND.values()] + [f"{v}\n44.161.181.40" for v in FOUND.values()]
    got, n = pseudonyms(spark, texts)
    assert n == [1] * 6 + [2] * 6 + [2] * 6
    for k, v in enumerate(FOUND.values()):
        new = got[k][2:-2]
        assert new != v and [c.isdigit() for c in new if c in "0123456789"] and re.sub(r"[0-9a-z]", "", new) == re.sub(r"[0-9a-z]", "", v)
        assert got[6 + k] == f"{new}, {new}; twice"
        assert got[12 + k] == f"{new}\n{got[1][2:-2]}"
    assert luhn(got[2][2:-2]) and all(0 <= int(x) <= 255 for x in got[1][2:-2].split("."))
    assert re.fullmatch(r"a \d{4}-(0[1-9]|1[0-2])-([0-2]\d|3[01]) b", got[5])
    assert pseudonyms(spark, texts, "other key")[0] != got


def test_pseudonyms_are_one_to_one(spark):
    dates = [f"{y}-{m:02d}-{d:02d}" for y in (1999, 2000) for m in range(1, 13) for d in range(1, 29)]
    addresses = [f"10.0.{a}.{b}" for a in range(8) for b in range(64)]
    numbers = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 665, 667, 899) for b in (1, 99) for c in range(1, 60)]
    mails = [f"{a}{b}{c}@x.org" for a in "abcdefgh" for b in "xyz" for c in range(10)]
    for values in (dates, addresses, numbers, mails):
        got, n = pseudonyms(spark, values)
        assert set(n) == {1} and len(set(got)) == len(values)


def test_what_fails_its_test_stays(spark):
    texts = ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "2001-02-30", "000-12-3456", "666-12-3456", "version 2.0", "31/31/1999", "a@b", "@x.org", "12345",
             "9" * 5000, "a" * 50_000, "", None]
    got, n = pseudonyms(spark, texts)
    assert got == texts and set(n) == {0}


def test_neighbours_are_found_apart(spark):
    got, n = pseudonyms(spark, ["+1 (755) 555-9729 44.161.181.40 4111111111111111 1987-02-28", "4111111111111111 44.161.181.40"])
    assert n == [4, 2]


MISSED = ["bob@example.com- hi", "bob@example.com--thanks", "bob@example.com-based", "bob@example.com.2", "bob@my-site.example.co.uk-", "1-800-555-1234",
          "1.555.123.4567", "1 (800) 555-1234", "+1.555.123.4567", "+44 (0)20 7946 0958", "+44 (0) 20 7946 0958", "2024/03/05", "2024.03.05", "05-03-2024",
          "12-31-1999", "5-3-2024"]


def test_more_notations_are_found(spark):
    got, n = pseudonyms(spark, [f"a {v} b" for v in MISSED])
    assert n == [1] * len(MISSED)
    for old, new in zip(MISSED, (g[2:-2] for g in got), strict=True):
        assert "bob@" not in new and new != old and new.partition("@")[2] == old.partition("@")[2]
        if "@" not in old and old != "5-3-2024":
            assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", old)
    by_old = dict(zip(MISSED, (g[2:-2] for g in got), strict=True))
    assert by_old["1-800-555-1234"].startswith("1-") and by_old["1.555.123.4567"].startswith("1.") and by_old["+44 (0)20 7946 0958"].startswith("+44 (0)")
    for old in MISSED[:4]:  # the address is the same, so its pseudonym is
        assert by_old[old].startswith(pseudonyms(spark, ["bob@example.com"])[0][0])
    assert re.fullmatch(r"(1[7-9]|20)\d\d/(0[1-9]|1[0-2])/([0-2]\d|3[01])", by_old["2024/03/05"])
    assert re.fullmatch(r"([0-2]\d|3[01])-(0[1-9]|1[0-2])-(1[7-9]|20)\d\d", by_old["05-03-2024"])
    assert by_old["2024/03/05"] == by_old["2024.03.05"].replace(".", "/")


def test_more_notations_keep_their_bounds(spark):
    texts = ["2001/02/30", "31-31-1999", "2024/03-05", "a@b.c-", "a@b.2", "a@" + "b." * 50_000 + "1", "a@" + "b-" * 50_000, "+44.161.181.40"]
    got, n = pseudonyms(spark, texts)
    assert got[:-1] == texts[:-1] and n == [0] * 7 + [1]
    assert got[-1][1:] == pseudonyms(spark, ["44.161.181.40"])[0][0]


# The permutations written anew in plain Python.
def plain_feistel(high, low, high_size, low_size, tweak, key="k"):
    for i in range(10):
        add = int(hashlib.sha256(f"{key}:{tweak}:{i}:{low if i % 2 == 0 else high}:{key}".encode()).hexdigest()[:15], 16)
        high, low = ((high + add) % high_size, low) if i % 2 == 0 else (high, (low + add) % low_size)
    return high, low


def plain_digits(s, tweak):
    u = len(s) // 2
    v = len(s) - u
    high, low = plain_feistel(int(s[:u] or 0), int(s[u:]), 10**u, 10**v, tweak)
    return (f"{high:0{u}d}" if u else "") + f"{low:0{v}d}"


def plain_day(day):
    first = datetime.date(1700, 1, 1)
    days = [first + datetime.timedelta(days=i) for i in range(146_097)]
    parts = [d for d in days if d.day <= 12], [d for d in days if d.day > 12]
    part, sizes, tweak = (parts[0], (240, 240), "early day") if day.day <= 12 else (parts[1], (9, 9833), "late day")
    rank = part.index(day)
    high, low = plain_feistel(rank // sizes[1], rank % sizes[1], *sizes, tweak)
    return part[high * sizes[1] + low]


def refill(template, digits):
    digits = iter(digits)
    return "".join(next(digits) if c.isdigit() else c for c in template)


def test_pseudonyms_equal_plain_python(spark):
    phones = {"+44 20 7946 0958": "44", "+442079460958": "44", "+1 (755) 555-9729": "1", "+7 495 123 45 67": "7", "+972 3 1234567": "972", "+49 30 901820": "49"}
    days = ["2024-03-05", "1700-01-01", "2099-12-31", "2000-02-29", "1999-10-13"]
    want = [refill(old, code + plain_digits(re.sub(r"\D", "", old)[len(code):], "phone" + code)) for old, code in phones.items()]
    want += [str(plain_day(datetime.date.fromisoformat(d))) for d in days]
    a, b = plain_feistel(44 * 256 + 161, 181 * 256 + 40, 65536, 65536, "ipv4")
    card = "4" + plain_digits("11111111111111", "card416")
    check = next(c for c in "0123456789" if luhn(card + c))
    assert pseudonyms(spark, [*phones, *days, "44.161.181.40", "4111111111111111"])[0] == [*want, f"{a // 256}.{a % 256}.{b // 256}.{b % 256}", card + check]


def test_one_value_has_one_pseudonym_in_every_notation(spark):
    same = [["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "0044 20 7946 0958", "+44-20-7946-0958"],
            ["(755) 555-9729", "+1 755 555 9729", "1-755-555-9729", "755.555.9729", "+1 (755) 555-9729", "+17555559729", "755 555 9729"],
            ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"]]
    dates = ["2024-03-05", "05/03/2024", "5/3/2024", "2024-03-25", "25.03.2024", "03/25/2024", "3-25-2024"]
    got, n = pseudonyms(spark, [x for group in [*same, dates] for x in group])
    assert set(n) == {1}
    for group in same:
        own, got = got[:len(group)], got[len(group):]
        assert len({g.replace(" ", "") if g.startswith("DE") else re.sub(r"\D", "", g)[-10:] for g in own}) == 1 and set(own).isdisjoint(group)
    as_day = [datetime.datetime.strptime(re.sub(r"[.-]", "/", g), f).date() for g, f in zip(got, ["%Y/%m/%d", *["%d/%m/%Y"] * 2, "%Y/%m/%d", "%d/%m/%Y", *["%m/%d/%Y"] * 2], strict=True)]
    assert len(set(as_day[:3])) == 1 and len(set(as_day[3:])) == 1 and as_day[0] != as_day[3]


def test_every_day_has_a_pseudonym_of_its_own(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1700-01-01', DATE'2099-12-31')) AS d")
    moved = days.select("d", pii._permute_day(F.col("d"), "k").alias("p"))
    assert moved.filter("p is null or (day(d) <= 12) <> (day(p) <= 12)").isEmpty() and moved.select("p").distinct().count() == 146_097
    # Day first and month first together: no two strings of different days meet.
    texts = days.filter("year(d) in (1700, 1771, 2000, 2080)").selectExpr("d", "explode(array_distinct(array(date_format(d, 'dd/MM/yyyy'), if(day(d) > 12, date_format(d, 'MM/dd/yyyy'), "
                                                                        "date_format(d, 'dd/MM/yyyy'))))) AS text")
    out = pii.pseudonymize(texts, "k")
    assert out.filter("n_pseudonyms <> 1").isEmpty() and out.select("text").distinct().count() == texts.count()


def test_what_is_no_iban_or_address_stays_and_long_matches_are_linear(spark):
    texts = ["DE89 3704 0044 0532 0130 01", "XX00 0000 0000 0000 0000", "a" * 65 + "@example.com", "x" * 1_000_000 + "@example.com", "+44 (0) 1", "+000 12 34"]
    began = time.monotonic()
    got, n = pseudonyms(spark, [*texts, "a" * 64 + "@example.com"])
    assert got[:-1] == texts and n == [0] * len(texts) + [1] and time.monotonic() - began < 120


def test_the_key_is_a_setting(spark):
    assert pii.key_of(spark) == pii.TEST_KEY
    spark.conf.set(pii.KEY_SETTING, "another")
    try:
        assert pii.key_of(spark) == "another"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_pii_odd_rows(spark):
    docs = odd_docs(spark)
    out = pii.pseudonymize(docs, "k")
    assert out.columns == docs.columns and dict(out.dtypes)["n_pseudonyms"] == "int"
    key = lambda r: (str(r.doc_id), r.text or "", str(r.source))
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.collect()))
    assert pii.pseudonymize(empty_docs(spark), "k").collect() == []


def test_op6_leaves_no_private_value(spark):
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    new = {r.doc_id: r.text for r in pii.op6_pii_pseudonyms(spark, BIG).collect()}
    assert old.keys() == new.keys()
    total = 0
    for d, t in old.items():
        values = [*re.findall(r"[\w.+-]+@[\w-]+\.[\w.-]*\w", t), *re.findall(r"\b\d{1,3}(?:\.\d{1,3}){3}\b", t), *re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", t),
                  *(x for x in re.findall(r"\b\d{16}\b", t) if luhn(x))]
        total += len(values)
        assert not any(v in new[d] for v in values)
        if not values and not re.search(r"\d", t):
            assert new[d] == t
    assert total > 20


# Operator 7

def brute_scores(rows, order, prior=lm_scoring.PRIOR):
    """rows: (text, held out). Tokens, known tokens, training tokens, base score and score of each."""
    tokens = [[*(t or "").encode("utf-8", "surrogatepass").lower().split(), b"\n"] for t, _ in rows]
    count = collections.Counter()
    for own, (_, out) in zip(tokens, rows, strict=True):
        if not out:
            s = [b"<s>", *own]
            count.update(tuple(s[i - n + 1:i + 1]) for i in range(len(s)) for n in range(1, order + 1) if i - n + 1 >= 0)
    single = {k[0]: v for k, v in count.items() if len(k) == 1 and k != (b"<s>",)}
    total, types = sum(single.values()), len(single)

    def p(state, w):
        if not state:
            return (single.get(w, 0) + 1) / (total + types + 1)
        seen = count[state]
        return (count[(*state, w)] + prior * p(state[1:], w)) / (seen + prior) if seen else p(state[1:], w)

    for own in tokens:
        s = [b"<s>", *own]
        yield (len(own), sum(w in single for w in own), total, sum(math.log10(p((), w)) for w in own),
               sum(math.log10(p(tuple(s[max(0, i - order + 1):i]), s[i])) for i in range(1, len(s))))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    rows = odd_docs(spark).select("doc_id", "text").collect()
    docs = odd_docs(spark).withColumn("held_out", held_out("doc_id", 7, 2))
    flags = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    got = lm_scoring.score_documents(docs, order=order, block_chars=30_000).collect()
    want = [(r.doc_id, f, *s) for r, f, s in zip(rows, flags, brute_scores([(r.text, f) for r, f in zip(rows, flags, strict=True)], order), strict=True)]
    key = lambda r: (str(r[0]), *r[1:4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_op7_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    flags = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    got = {r.doc_id: tuple(r)[1:] for r in lm_scoring.op7_lm_scoring(spark, SF).collect()}
    for r, f, s in zip(rows, flags, brute_scores([(r.text, f) for r, f in zip(rows, flags, strict=True)], lm_scoring.ORDER), strict=True):
        assert got[r.doc_id][:4] == (f, *s[:3]) and got[r.doc_id][4:] == pytest.approx(s[3:], rel=1e-9)


def test_scores_without_rows(spark):
    assert lm_scoring.score_documents(empty_docs(spark).withColumn("held_out", held_out("doc_id", 7, 2))).collect() == []
    only = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")
    (r,) = lm_scoring.score_documents(only).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_packed_messages_round_trip():
    h = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    c = np.arange(1000)
    a, b = lm_scoring._unpack(lm_scoring._pack(h, c))
    assert (a == h).all() and (b == c).all()
    assert (lm_scoring._unpack_counts(lm_scoring._pack_counts(c * 2**33)) == c * 2**33).all()


# Pipeline

def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r.doc_id: r for r in docs.collect()}
    classes_ = brute_classes(spark, docs)
    kept = {d for d, c in classes_.items() if d == c}
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = written(stage(spark, step, SF), "test-pipeline")
        assert step.columns == corpus_pipeline.COLUMNS
    rows = {r.doc_id: r for r in step.collect()}
    assert rows.keys() == kept  # every document has letters of a certain language
    assert all(re.sub(r"[0-9a-z]", "", rows[d].text) == re.sub(r"[0-9a-z]", "", first[d].text) for d in kept)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == kept
    fill = collections.Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096


def test_pipeline_stages_on_odd_and_empty_rows(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        step = docs
        for _, stage in corpus_pipeline.STAGES:
            step = written(stage(spark, step, SF), "test-pipeline")
        got = {r.doc_id for r in step.collect()}
        assert got <= {r.doc_id for r in docs.collect()}
        if docs.count():
            assert {4, 6, 7, 11, None} <= got and not got & {0, 1, 2, 3, 5, 12}


# Operator 7 on lanes and hot rows

def test_lanes_carry_the_state_of_one_walk(monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(list("abcde"), rng.integers(0, 60)))) for i in range(40)]
    texts = [t for _, t in rows]
    for order in (2, 3, 4):
        t = lm_scoring.Tokens(texts, order)
        counts = [np.bincount(p[p >= 0], minlength=len(g)) for p, g in zip(t.place, t.grams, strict=True)]
        machine = lm_scoring.Automaton(t, counts, int(counts[0].sum()), len(counts[0]), len(texts), order, lm_scoring.PRIOR)
        want = [s[-1] for s in brute_scores([(x, False) for x in texts], order)]
        assert machine.walk(t.offsets) == pytest.approx(want, rel=1e-9)
        with monkeypatch.context() as m:
            m.setattr(lm_scoring, "LANE_TOKENS", 5)
            assert machine.walk(t.offsets) == pytest.approx(want, rel=1e-9)
        # The weights of a state and its failure arcs sum to one.
        for state in (0, 1, machine.start, len(machine.passed) - 1):
            _, w = machine.step(np.full(machine.width, state), np.arange(machine.width))
            unknown = 1 / (counts[0].sum() + len(counts[0]) + 1) * 10.0 ** sum(_failures(machine, state))
            assert (10.0 ** w).sum() + unknown == pytest.approx(1)


def _failures(machine, state):
    while state:
        yield machine.fail_weight[state]
        state = machine.fail_to[state]


def test_equal_rows_are_dealt_to_all_blocks(spark):
    docs = spark.createDataFrame([(None, "the same text again")] * 900 + [(i, f"text {i}") for i in range(900)], "doc_id long, text string").withColumn("held_out", F.lit(False))
    got = lm_scoring.score_documents(docs.repartition(3), block_chars=10_000)
    assert got.count() == 1800 and got.filter("doc_id is null").select("score").distinct().count() == 1
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "monotonically_increasing_id" in plan

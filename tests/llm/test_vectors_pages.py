"""Operators 1, 8 and 9: SQL oracles, brute force, odd rows."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import catalog, pq_dedup, segment_search, warc_audit

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, score double, node string"


def odd_vectors(spark, extra=()):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), 0.0, "") for i in range(200)]
    rows += [(200, None, 0.0, ""), (201, [], 0.0, ""), (202, [1.0] * 7 + [None], 0.0, ""), (203, [1.0] * 7 + [math.nan], 0.0, ""),
             (204, [math.inf] * 8, 0.0, ""), (205, [0.0] * 8, 0.0, ""), (None, rows[3][1], 0.0, ""), rows[50], (300, rows[7][1], 0.0, ""),
             (301, [2 * x for x in rows[9][1]], 0.0, ""), (302, [1.0, 2.0, 3.0], 0.0, ""), (350, [1.0, 2.0, 3.1], 0.0, ""), (303, rows[7][1], 0.0, "")]
    return spark.createDataFrame(rows + list(extra), VECTORS)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_oracles(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(catalog.ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    order = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(order).collect())) == sorted(want.fetchall())


def brute_top(rows, k):
    whole = [(r.vec_id, np.floor(256 * np.array(r.embedding, np.float64))) for r in rows if r.vec_id is not None and r.embedding
             and all(x is not None and math.isfinite(x) for x in r.embedding)]
    asked = {(i, tuple(v)) for i, v in whole if i % 50 == 0}
    for i, v in asked:
        best = sorted((-int(np.dot(v, w)), j) for j, w in whole if j != i and len(w) == len(v))[:k]
        yield from ((i, n + 1, j, -s) for n, (s, j) in enumerate(best))


@pytest.mark.parametrize("block", [2048, 2])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(segment_search, "BLOCK_QUERIES", block)
    monkeypatch.setattr(segment_search, "CHUNK", 16)
    vectors = odd_vectors(spark)
    got = segment_search.top_k(vectors, F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(vectors.collect(), 5))


def test_top_k_ties_and_huge_components(spark):
    rows = [(i, [1.0, 1.0], 0.0, "") for i in range(60)] + [(100, [1e30, 1.0], 0.0, ""), (101, [1e30, -1.0], 0.0, "")]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in segment_search.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, 3).collect()}
    assert got[0, 1] == (100, 2**63 - 1) or got[0, 1][0] in (100, 101)
    assert got[50, 3] == (0, 2 * 256 * 256)


def test_bounds_are_bounds():
    rng = np.random.default_rng(9)
    q, v = rng.normal(size=(30, 37)) * 100, rng.normal(size=(40, 37)) * 100
    for s in (1, 4, 16, 64):
        assert (segment_search.statistics(q, s) @ segment_search.statistics(v, s).T >= q @ v.T - 1e-6).all()


def test_top_k_empty(spark):
    assert segment_search.top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).collect() == []


def brute_links(rows, cosine=0.95):
    unit = {}
    for k, r in enumerate(rows):
        if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding):
            v = np.array(r.embedding, np.float64)
            unit[k] = v / np.linalg.norm(v)
    root, degree = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, u in unit.items():
        for b, w in unit.items():
            if a < b and len(u) == len(w) and u @ w >= cosine:
                degree[a] += 1
                degree[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, r in enumerate(rows):
        if r.vec_id is not None:
            low[find(k)] = min(low.get(find(k), r.vec_id), r.vec_id)
    return sorted((str(r.vec_id), degree[k], str(low.get(find(k)))) for k, r in enumerate(rows))


def near(rng, base, n, start, spread):
    return [(start + i, (base + rng.normal(size=len(base)) * spread).tolist(), 0.0, "") for i in range(n)]


@pytest.mark.parametrize(("block", "sample"), [(2048, 20_000), (16, 30)])
def test_links_equal_brute_force(spark, monkeypatch, block, sample):
    for name in ("BLOCK", "CHUNK"):
        monkeypatch.setattr(pq_dedup, name, block)
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", 20)
    rng = np.random.default_rng(10)
    groups = [r for g in range(4) for r in near(rng, rng.normal(size=8), 25, 1000 + 100 * g, 0.07 * (g + 1))]
    vectors = odd_vectors(spark, groups + near(rng, rng.normal(size=20), 30, 2000, 0.2))
    rows = vectors.collect()
    got = pq_dedup.linked_vectors(vectors, sample_rows=sample).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_few_probes_find_nine_links_in_ten_and_none_twice(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "LIST_ROWS", 10)
    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([r for g in range(60) for r in near(rng, rng.normal(size=16), 10, 100 * g, 0.04)], VECTORS)
    exact = {r.vec_id: r.n_links for r in pq_dedup.linked_vectors(vectors, probes=None).collect()}
    assert sorted((str(k), n) for k, n in exact.items()) == [(i, n) for i, n, _ in brute_links(vectors.collect())]
    for probes in (1, 3):
        got = {r.vec_id: r.n_links for r in pq_dedup.linked_vectors(vectors, probes=probes).collect()}
        assert all(got[k] <= n for k, n in exact.items())
        if probes == 3:
            assert sum(got.values()) >= 0.9 * sum(exact.values()) > 0


def test_links_empty(spark):
    assert pq_dedup.linked_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_op9_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in pq_dedup.op9_pq_dedup(spark, SF).collect())
    assert got == brute_links(rows)


RECORDS = "archive string, offset long, record binary, other int"


def archive(n=400, size=300):
    rng = np.random.default_rng(11)
    rows, at = [], {}
    for i in range(n):
        name = f"a{i % 3}"
        data = rng.bytes(int(rng.integers(1, size)))
        rows.append([name, at.get(name, 0), data, 1])
        at[name] = at.get(name, 0) + len(data)
    return rows


def audit(spark, left, right):
    a, b = (warc_audit.manifest(spark.createDataFrame([tuple(r) for r in x], RECORDS)) for x in (left, right))
    return sorted((r.archive or "", r.offset if r.offset is not None else -1, r.status) for r in warc_audit.audit(a, b).collect())


def test_audit_finds_all_damage(spark, monkeypatch):
    monkeypatch.setattr(warc_audit, "STRETCH", 512)
    left = archive()
    right = [list(r) for r in left]
    right[17][2] = bytes([right[17][2][0] ^ 1]) + right[17][2][1:]
    right[200][2] = b""
    gone = right.pop(300)
    right += [["a1", 10**7, b"more", 1], ["new", 0, b"x", 1]]
    want = [(*left[17][:2], "corrupt"), (*left[200][:2], "corrupt"), (*gone[:2], "missing"), ("a1", 10**7, "extra"), ("new", 0, "extra")]
    assert audit(spark, left, right) == sorted(want)
    assert audit(spark, left, left) == []


def test_audit_odd_rows(spark):
    rows = [[None, None, None, 1], ["a", 0, b"", None], ["a", 0, b"again", 1], ["a", 0, b"again", 1], ["b", None, b"z", 1]]
    assert audit(spark, rows, list(reversed(rows))) == []
    assert audit(spark, rows, rows[:-2]) == [("a", 0, "corrupt"), ("b", -1, "missing")]
    assert audit(spark, [], []) == []
    assert audit(spark, rows, []) == [("", -1, "missing"), ("a", 0, "missing"), ("b", -1, "missing")]


def test_audit_against_counts(spark, monkeypatch):
    """A third of the records without an offset, most of them alike, others at a few places: audited as counting all of them says."""
    monkeypatch.setattr(warc_audit, "STRETCH", 512)
    monkeypatch.setattr(warc_audit, "SLOTS", 8)
    rng = np.random.default_rng(4)
    left = [["a", None, b"same", 1] for _ in range(300)] + [["a", None, b"r%d" % i, 1] for i in range(400)]
    left += [[f"a{i % 3}", int(rng.integers(0, 4000)), b"x%d" % (i % 50), 1] for i in range(1400)]
    right = [list(r) for r in left if rng.random() > 0.01]
    for r in right:
        if rng.random() < 0.01:
            r[2] += b"!"
    kept = [Counter((a, o, len(d), hashlib.sha256(d).hexdigest()) for a, o, d, _ in x) for x in (left, right)]
    places = [Counter((k[0], k[1]) for k in x.elements()) for x in kept]
    want = {}
    for k in kept[0].keys() | kept[1].keys():
        if kept[0][k] != kept[1][k]:
            here, there = (p[k[:2]] for p in places)
            want[k[:2]] = ("corrupt" if here and there else "missing" if here else "extra", here, there)
    a, b = (warc_audit.manifest(spark.createDataFrame([tuple(r) for r in x], RECORDS)) for x in (left, right))
    got = warc_audit.audit(a, b).collect()
    assert {(r.archive, r.offset): (r.status, r.left_records, r.right_records) for r in got} == want and len(got) == len(want)
    for r in got:
        for side, (more, less) in {"left": kept, "right": kept[::-1]}.items():
            most = sorted(k[2:] for k in more if k[:2] == (r.archive, r.offset) and more[k] > less[k])
            assert (r[f"{side}_length"], r[f"{side}_digest"]) == (most[0] if most else (None, None))
    # No group that is hashed at once holds the records of the hot place: copies are one row, the others lie in many parts.
    rows = warc_audit.dealt(a)
    assert rows.where("offset is null").agg({"copies": "max"}).first()[0] == 300
    assert rows.groupBy("archive", "node", "part").count().agg({"count": "max"}).first()[0] < 40


def test_records_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, "http://a", "<p>"), (None, None, None), (2, None, "é"), (2, None, "é")], "page_id long, url string, html string")
    got = warc_audit.page_records(pages).orderBy("archive", "offset").collect()
    assert [r.archive for r in got] == ["pages-0"] * 3 + ["pages-none"]
    assert [r.offset for r in got[:3]] == [0, len(got[0].record), len(got[0].record) + len(got[1].record)]
    assert bytes(got[1].record).endswith("Content-Length: 2\r\n\r\né\r\n\r\n".encode())

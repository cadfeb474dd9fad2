"""Operators: flatten round trip (property), bounded nesting of hot parents, joins, versions, plans."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketlens.operators import flatten, joins, project, window
from marketlens.plans.standins import nest_pages
from marketlens.sources.landed import parse_json_text

child = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-5, 5)),
                  st.text("абвxyz", max_size=4))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(child, max_size=25))
def test_nest_then_flatten_round_trip(spark, data):
    """Flat rows -> nested JSON (pages per parent) -> typed read -> explode equals the flat rows."""
    df = spark.createDataFrame(data, "parent int, n int, s string")
    nested = nest_pages(df, ["parent"], F.struct("n", "s"), ["n", "s"], page_size=4)
    text = nested.select("parent", F.to_json(F.struct(F.col("items").alias("items"))).alias("payload"))
    back = parse_json_text(text, "payload", "items array<struct<n:int, s:string>>", ["parent"])
    flat = flatten.explode_with_meta(back, "items", keep=["parent"])
    assert rows(flat, "parent", "n", "s") == rows(df, "parent", "n", "s")


def test_nest_pages_splits_a_hot_parent(spark):
    df = spark.range(1000).select(F.lit(1).alias("p"), F.col("id"))
    pages = nest_pages(df, ["p"], F.col("id"), ["id"], page_size=100)
    sizes = [r[0] for r in pages.select(F.size("items")).collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) < 300


def test_explode_drops_empty_and_null_parents(spark):
    df = spark.createDataFrame([(1, [(1, "a")]), (2, []), (3, None)], "k int, arr array<struct<x:int, y:string>>")
    assert rows(flatten.explode_with_meta(df, "arr", keep=["k"])) == [(1, 1, "a")]


def test_recursive_flatten_measures_and_declares(spark):
    df = spark.createDataFrame([((1, (2.5, None)), [1, 2, 3]), ((None, None), [])],
                               "a struct<x:int, b:struct<y:double, z:string>>, t array<int>")
    out = flatten.recursive_flatten(df)
    assert out.columns == ["a_x", "a_b_y", "a_b_z", "t_0", "t_1", "t_2"]
    assert rows(out) == [(1, 2.5, None, 1, 2, 3), (None, None, None, None, None, None)]
    assert flatten.recursive_flatten(df, {"t": 1}).columns[-1] == "t_2"  # never below the data
    assert flatten.recursive_flatten(df, {"t": 4}).columns[-1] == "t_3"
    with pytest.raises(ValueError, match="more than 2 columns"):
        flatten.recursive_flatten(df, max_columns=2)


def test_recursive_flatten_arrays_in_arrays(spark):
    df = spark.createDataFrame([([(1, [1, 2, 3]), (2, [])], [[1], [2, 3]], None), ([(3, [9])], None, ([["x"]],))],
                               "r array<struct<n:int, vals:array<int>>>, m array<array<int>>, s struct<d:array<array<string>>>")
    out = flatten.recursive_flatten(df)
    assert out.columns == ["r_0_n", "r_0_vals_0", "r_0_vals_1", "r_0_vals_2", "r_1_n", "r_1_vals_0", "r_1_vals_1", "r_1_vals_2",
                           "m_0_0", "m_0_1", "m_1_0", "m_1_1", "s_d_0_0"]
    assert rows(out) == [(1, 1, 2, 3, 2, None, None, None, 1, None, 2, 3, None), (3, 9, *[None] * 10, "x")]


def test_first_element_and_prefixed_struct(spark):
    df = spark.createDataFrame([([("a", "1"), ("b", "2")], ("S", 5)), ([], None)],
                               "items array<struct<name:string, sku:string>>, posting struct<sch:string, wh:int>")
    out = df.select(*flatten.first_element_fields("items", {"item_name": "name"}),
                    *flatten.prefixed_struct("posting", ["sch", "wh"], "posting_"))
    assert rows(out) == [("a", "S", 5), (None, None, None)]


def test_conform_and_row_to_json(spark):
    df = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 2, 3, 4, 5))], "b int, a string, t timestamp_ntz")
    out = project.conform(df, [("a", "string"), ("b", "int"), ("c", "double")])
    assert out.columns == ["a", "b", "c"] and out.first().c is None
    j = project.row_to_json(df.withColumn("n", F.lit(None).cast("string"))).first().metadata_json
    assert j == '{"b":1,"a":"x","t":"2024-01-02T03:04:05","n":null}'


def test_latest_version_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, None, "z"), (2, 1, "c")], "k int, v int, p string")
    assert rows(window.latest_version(df, ["k"], "v")) == [(1, 2, "b"), (2, 1, "c")]


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(None, "n"), (2, "t")], "k int, b string")
    assert rows(joins.left_join(left, right, ["k"])) == [(2, 2, "t"), (None, 1, None)]
    assert rows(joins.left_join(left, right, ["k"], null_safe=True)) == [(2, 2, "t"), (None, 1, "n")]
    renamed = joins.left_join_renamed(left, right.withColumnRenamed("k", "kk"), ["k"], ["kk"])
    assert renamed.columns == ["k", "a", "b"]


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows: results stay whole and every aggregate keeps a partial (map-side)
    step before its shuffle, so the hot key is pre-reduced on each map task."""
    from marketlens.operators.aggregate import daily_ad_fact

    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 97).alias("v"), F.col("id").cast("string").alias("s"))
    latest = window.latest_version(base, ["k"], "v")
    assert latest.count() == 1 + (n - n // 3)
    assert latest.filter("k = -1").first().v == 96
    plan = latest._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "partial_max" in plan
    flat = base.select(F.lit("P").alias("Project"), F.lit("M").alias("Marketplace"),
                       F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("date"), F.col("k").alias("nmId"),
                       F.lit(1).alias("advertId"), F.col("s").alias("name"), F.col("v").alias("views"),
                       *[F.lit(None).cast("bigint").alias(c) for c in ("clicks", "atbs", "orders", "shks")],
                       *[F.lit(1.0).alias(c) for c in ("sum", "sum_price", "ctr", "cpc", "cr")])
    fact = daily_ad_fact(flat, order_cols=("date",))
    hot = fact.filter("nmId = -1").first()
    assert hot.views == sum(i % 97 for i in range(0, n, 3)) and hot.sum == float(n // 3)
    assert "partial_sum" in fact._jdf.queryExecution().executedPlan().toString()
    pages = nest_pages(base, ["k"], F.col("v"), ["v", "s"], page_size=1000)
    hot_pages = pages.filter("k = -1").select(F.size("items").alias("n")).collect()
    assert sum(r.n for r in hot_pages) == n // 3 and len(hot_pages) == 10 and max(r.n for r in hot_pages) < 2000


version_rows = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)),
                                  st.text("abc", max_size=2)), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(version_rows)
def test_latest_version_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, v int, p string")
    expected = {}
    for k, v, p in data:  # highest version, null lowest; ties broken by the highest other column
        rank = (v is not None, v if v is not None else 0, p)
        if k not in expected or rank > expected[k][0]:
            expected[k] = (rank, (k, v, p))
    assert rows(window.latest_version(df, ["k"], "v")) == sorted(
        (r for _, r in expected.values()), key=lambda t: tuple((x is None, str(x)) for x in t))


weeks = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 12)), max_size=20,
                 unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(weeks)
def test_period_change_matches_brute_force(spark, data):
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(p, base + dt.timedelta(weeks=w), n) for p, w, n in data],
                               "p int, week date, n bigint")
    got = {(r.p, r.week): (r.prev_n, r.change) for r in
           window.period_change(df, ["p"], "week", "n", lambda c: F.date_sub(c, 7)).collect()}
    counts = {(p, w): n for p, w, n in data}
    for (p, w), n in counts.items():
        prev = counts.get((p, w - 1))  # only the immediately preceding week counts
        change = round(n / prev - 1, 6) if prev else None
        assert got[(p, base + dt.timedelta(weeks=w))] == (prev, change)


ad_rows = st.lists(st.tuples(
    st.integers(0, 1), st.sampled_from([1, 2, None]), st.sampled_from([10, 11]), st.integers(0, 3),
    st.sampled_from([None, "a", "b"]), st.one_of(st.none(), st.integers(0, 5)),
    st.one_of(st.none(), st.integers(0, 999).map(lambda c: c / 100)),
    st.one_of(st.none(), st.integers(0, 99).map(lambda c: c / 10))), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ad_rows)
def test_daily_ad_fact_matches_brute_force(spark, data):
    """AGG-1 against a plain-Python version of the source's semantics."""
    from decimal import Decimal

    from marketlens.operators.aggregate import daily_ad_fact

    base = dt.datetime(2024, 3, 1, 8)
    flat_rows = [(base + dt.timedelta(days=d, hours=h), nm, adv, name, views, money, ratio)
                 for d, nm, adv, h, name, views, money, ratio in data]
    df = spark.createDataFrame(flat_rows, "date timestamp_ntz, nmId int, advertId int, name string, views bigint, "
                                          "sum double, ctr double")
    df = df.select("*", *[F.lit(None).cast("bigint").alias(c) for c in ("clicks", "atbs", "orders", "shks")],
                   F.lit(None).cast("double").alias("sum_price"), F.col("ctr").alias("cpc"),
                   F.col("ctr").alias("cr"))
    got = {(r.day, r.nmId, r.advertId): (r.date, r.name, r.views, r.sum, r.ctr)
           for r in daily_ad_fact(df, keys=(), order_cols=("date",)).collect()}
    groups = {}
    for ts, nm, adv, name, views, money, ratio in flat_rows:
        if nm is None:
            continue  # null keys are dropped
        groups.setdefault((ts.date(), nm, adv), []).append((ts, name, views, money, ratio))
    expected = {}
    for k, g in groups.items():
        named = sorted((ts, n) for ts, n, *_ in g if n is not None)
        ratios = [r for *_, r in g if r is not None]
        expected[k] = (min(ts for ts, *_ in g), named[0][1] if named else None,
                       sum(v for _, _, v, _, _ in g if v is not None),
                       float(sum((Decimal(str(m)) for _, _, _, m, _ in g if m is not None), Decimal(0))),
                       round(sum(ratios) / len(ratios), 6) if ratios else None)
    assert got == expected

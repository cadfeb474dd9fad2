"""Every registered query against its DuckDB oracle on the smallest supplied tables, plus plan shapes."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from marketlens.plans.catalog import ORACLE_SQL, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    s_cols = df.columns
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(s_cols) == sorted(d_cols)
    d_rows = res.fetchall()
    order = sorted(s_cols)
    s = sorted("|".join(canon(r[c]) for c in order) for r in df.collect())
    d = sorted("|".join(canon(r[d_cols.index(c)]) for c in order) for r in d_rows)
    assert len(s) == len(d)
    assert s == d


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["Project", "Marketplace", "day", "nmId", "advertId"] and df.count() > 0


def _plan(df):
    """The executed plan; for an adaptive plan, only its final section (the initial one repeats the tree)."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_flagship_plan_one_shuffle_and_pruned_scan(spark):
    df = E.queries()["ad_daily_fact"](spark, SF)
    df.collect()
    plan = _plan(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string" in plan


def test_filters_reach_the_scan(spark):
    df = E.queries()["one_product_sum"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,42)]" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in text


def test_top_k_plans_take_ordered(spark):
    df = E.queries()["top_products"](spark, SF)
    df.collect()
    assert "TakeOrderedAndProject" in _plan(df)


def test_latest_version_is_a_partial_aggregate(spark):
    df = E.queries()["latest_version"](spark, SF)
    df.collect()
    plan = _plan(df)
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1

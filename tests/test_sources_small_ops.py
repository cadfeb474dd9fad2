"""Landed-layout reads (partition discovery and pruning) and the small filter/sort/set/aggregate operators."""

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import rows
from marketlens import schemas
from marketlens.operators import aggregate, filters, setops, sort
from marketlens.plans import ads
from marketlens.sources.landed import read_landed


def stats_doc(advert, nm, day, views):
    return {"advertId": advert, "days": [{"date": f"{day}T12:00:00", "apps": [
        {"appType": 1, "nm": [{"nmId": nm, "name": f"p{nm}", "views": views}]}]}]}


def test_landed_layout_partitions_are_columns_and_pruned(spark, tmp_path):
    root = tmp_path / "adstats"
    for project in ("P1", "P2"):
        for day in ("2024-03-01", "2024-03-02"):
            d = root / f"Project={project}" / f"day={day}"
            d.mkdir(parents=True)
            for page in range(2):  # two pages of one response are just two files
                (d / f"page-{page}.json").write_text(json.dumps(stats_doc(10, 1, day, 5 + page), indent=1))
    landed = read_landed(spark, str(root), schemas.AD_STATS)
    assert {"Project", "day"} <= set(landed.columns)
    one_day = landed.filter(F.col("day") == F.lit("2024-03-01").cast("date"))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-03-01" in plan
    facts = ads.ad_daily_fact(ads.flatten_ad_stats(one_day.withColumn("Marketplace", F.lit("Wildberries"))))
    assert rows(facts, "Project", "day", "nmId", "advertId", "views") == [
        ("P1", dt.date(2024, 3, 1), 1, 10, 11), ("P2", dt.date(2024, 3, 1), 1, 10, 11)]


def test_filters(spark):
    df = spark.createDataFrame([("2024-08-31T10:00:00", "a", 1, None), ("2024-09-01T00:00:00", "b", 2, True),
                                ("garbage", "c", 3, False)], "t string, p string, v int, error boolean")
    assert rows(filters.on_or_after(df, "t", "2024-09-01"), "p") == [("b",), ("c",)]  # text compare, as the source
    assert rows(filters.valid_timestamps(df, "t"), "p") == [("a",), ("b",)]
    assert rows(filters.equals(df, "p", "b"), "v") == [(2,)]
    ts = filters.valid_timestamps(df, "t")
    assert rows(filters.up_to_day_end(ts, "t", "2024-08-31"), "p") == [("a",)]
    assert rows(filters.year_at_least(ts, "t", 2025), "p") == [] and filters.year_at_least(ts, "t", None) is ts
    days = ts.withColumn("d", F.to_date("t"))
    assert rows(filters.day_between(days, "d", "2024-09-01", "2024-09-30"), "p") == [("b",)]
    assert rows(filters.successful_payloads(df.withColumn("payload", F.col("p")), "payload"), "p") == [("a",), ("c",)]
    assert rows(filters.after_high_water_mark(df, "v", 2), "v") == [(2,), (3,)]
    assert rows(filters.after_high_water_mark(df, "v", 2, inclusive=False), "v") == [(3,)]
    assert filters.after_high_water_mark(df, "v", None) is df


def test_sorts_and_top_k(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 1.0)], "k int, r double")
    assert [r.k for r in sort.top_k(df, "r", 2, ["k"]).collect()] == [2, 3]
    assert [r.k for r in sort.sort_desc(df, "r", ["k"]).collect()] == [2, 3, 1, 4]
    assert sort.head(df, 3).count() == 3


def test_union_and_aggregates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.5)], "k int, b double")
    u = setops.union_projects({"A": a, "B": b})
    assert rows(u, "Project", "k", "a", "b") == [("A", 1, "x", None), ("B", 2, None, 3.5)]
    money = spark.createDataFrame([("g", 0.1), ("g", 0.2), ("h", None)], "g string, m double")
    got = {r.g: r for r in aggregate.regroup_sum(money, ["g"], money=["m"], row_count="n").collect()}
    assert (got["g"].m, got["g"].n, got["h"].m) == (0.3, 2, 0.0)  # exact decimal sum, all-null -> 0
    kept = aggregate.regroup_sum(money, ["g"], money=["m"], keep_decimal=True)
    assert dict(kept.dtypes)["m"].startswith("decimal")
    assert aggregate.total(money, "m", "t", 2).first().t == 0.3
    assert aggregate.distinct_count(money, "g", "n").first().n == 2
    assert rows(aggregate.distinct_values(money, ["g"])) == [("g",), ("h",)]
    tiny = spark.createDataFrame([(0.004,)] * 3, "m double")
    assert aggregate.total(tiny, "m", "t", aggregate.SUM_SCALE).first().t == 0.012

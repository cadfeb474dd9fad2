"""Checks on landed data and loads that may run again: page sequences, cursors, counted casts, coverage, ledger, write layout, lossless flattening."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketlens.functions.clean import to_double
from marketlens.operators import casts, coverage, pages
from marketlens.operators.aggregate import regroup_switches
from marketlens.operators.flatten import recursive_flatten, variant_leaves
from marketlens.operators.quality import all_successful, response_audit
from marketlens.operators.window import rolling_periods, selected_and_previous
from marketlens.plans import ads, finance
from marketlens.schemas import AD_STATS, FINANCE_OPERATIONS
from marketlens.sinks import writers
from marketlens.sources.landed import landed_responses, parse_json_text


# ------------------------------------------------------------------------------------------------ responses and their audit
def write(root, project, day, name, text):
    folder = root / f"project={project}" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_audit_has_a_row_for_each_file_and_each_damaged_page(spark, tmp_path):
    good = json.dumps({"advertId": 1, "days": []})
    write(tmp_path, "a", "2024-01-01", "p1.json", good + "\n" + good + "\n")
    write(tmp_path, "a", "2024-01-01", "p2.json", good + "\n{bad one\n\n{bad two\n")
    write(tmp_path, "b", "2024-01-05", "p1.json", good)
    audit = response_audit(landed_responses(spark, str(tmp_path), AD_STATS, multi_line=False), "2024-02-01 00:00:00")
    got = sorted((r.API, str(r.day), os.path.basename(r.File), r.Pages, r["Status Code"], r.Status, r["Response Text"] or "") for r in audit.collect())
    assert got == [("a", "2024-01-01", "p1.json", 2, 200, "Successful", ""), ("a", "2024-01-01", "p2.json", 1, 200, "Successful", ""),
                   ("a", "2024-01-01", "p2.json", 1, 500, "Error", "{bad one"), ("a", "2024-01-01", "p2.json", 1, 500, "Error", "{bad two"),
                   ("b", "2024-01-05", "p1.json", 1, 200, "Successful", "")]
    assert {os.path.getsize(tmp_path / "project=b/day=2024-01-05/p1.json")} == {r.Bytes for r in audit.filter("API = 'b'").collect()}
    assert not all_successful(audit, ["a", "b"]) and all_successful(audit.filter("API = 'b'"), ["b"])


def test_whole_files_as_responses(spark, tmp_path):
    write(tmp_path, "a", "2024-01-01", "list.json", json.dumps([{"advertId": 1}, {"advertId": 2}], indent=1))
    write(tmp_path, "a", "2024-01-01", "cut.json", '[{"advertId": 1}, {"adv')
    write(tmp_path, "a", "2024-01-02", "blank.json", " \n")
    got = sorted((os.path.basename(r.file), r.text) for r in landed_responses(spark, str(tmp_path), AD_STATS).collect() if r.text is not None)
    assert got == [("blank.json", " \n"), ("cut.json", '[{"advertId": 1}, {"adv')]


# ------------------------------------------------------------------------------------------------ page sequences and cursors
def test_page_problems(spark):
    data = [("a", 1, True), ("a", 2, True), ("a", 5, True), ("a", 5, True), ("a", 6, False),  # 3 and 4 missing, 5 double
            ("b", 2, True), ("b", 3, True),  # 1 missing, and what follows 3
            ("c", 1, False), ("c", 2, False),  # ends early
            ("d", 1, False), ("e", 1, None), (None, 2, False), ("f", None, True), ("g", 1, False)]
    df = spark.createDataFrame(data, "project string, page int, isNextPage boolean").withColumn("day", F.lit("2024-01-01"))
    got = {tuple(r)[:1] + tuple(r)[2:] for r in pages.page_problems(df).collect()}
    assert got == {("a", "missing", 3, 4), ("a", "double", 5, 5), ("b", "missing", 1, 1), ("b", "last page missing", 4, None),
                   ("c", "pages after the last", 1, 1), (None, "missing", 1, 1), ("f", "no number", None, None)}
    left = pages.complete_groups(df, pages.page_problems(df))
    assert {r.project for r in left.collect()} == {"d", "e", "g"}
    assert pages.page_problems(df.limit(0)).count() == 0


def test_cursor_problems_equal_a_sweep(spark):
    random.seed(4)
    data = []
    for project, n in (("hot", 400), ("p1", 30), (None, 20), ("one", 1)):
        at = random.randint(0, 1000)
        for _ in range(n):
            lo = at + 1 + random.choice([0, 0, 0, 0, 7, -5])
            data.append((project, lo, lo + random.randint(0, 90)))
            at = max(at, data[-1][2])
    data += [("p1", None, None)]
    random.shuffle(data)
    want = set()
    for project in {d[0] for d in data}:
        top = None
        for lo, hi in sorted((lo, hi) for p, lo, hi in data if p == project and lo is not None):
            if top is not None and lo <= top:
                want.add((project, "overlap", lo, min(hi, top)))
            elif top is not None and lo > top + 1:
                want.add((project, "hole", top + 1, lo - 1))
            top = hi if top is None else max(top, hi)
    df = spark.createDataFrame(data, "project string, first_id long, last_id long")
    for buckets in (1, 7, 256):
        assert {tuple(r) for r in pages.cursor_problems(df, buckets=buckets).collect()} == want
    assert pages.cursor_problems(df.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ counted casts
def test_casts_are_counted_and_stop_a_bad_load(spark, tmp_path):
    df = spark.createDataFrame([(1, "1.5"), (2, "x"), (3, None), (4, "NaN"), (5, "7")], "id long, price string")
    target = writers.Target(str(tmp_path / "t"), [("id", "bigint"), ("price", "double")])
    writers.create_table(spark, target)
    with pytest.raises(casts.TooManyBadValues, match="price: 2 of 4"):
        casts.append_checked(spark, df, {"price": to_double("price")}, target, most_failed=0.4)
    assert writers.read(spark, target).count() == 0
    assert casts.append_checked(spark, df, {"price": to_double("price")}, target, most_failed=0.5) == [("price", 5, 1, 2)]
    assert rows(writers.read(spark, target)) == [(1, 1.5), (2, None), (3, None), (4, None), (5, 7.0)]
    assert casts.append_checked(spark, df.limit(0), {"price": to_double("price")}, target) == [("price", 0, 0, 0)]


def test_text_that_is_no_number_is_not_tried_but_all_numbers_are(spark):
    texts = ["1", " 1", "\t1.5 ", "+2", "-3e4", ".5", "5.", "1d", "2F", "Infinity", "-infinity", "inf", "+INF", "nan", "NaN", "n/a", "i", "abc", "", " ", "- 1", "e5", "0x10", "١", "1,5", "\x001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", to_double("t").alias("got"), F.nanvl(F.col("t").try_cast("double"), F.lit(None).cast("double")).alias("want")).collect():
        assert r.got == r.want, r.t


# ------------------------------------------------------------------------------------------------ coverage
def test_intervals_merge_and_zero_means_landed(spark):
    loads = spark.createDataFrame([("p", "2024-01-30", "2024-02-02"), ("p", "2024-02-01", "2024-02-10"), ("p", "2024-02-11", "2024-02-11"), ("p", "2024-05-01", "2024-05-01"),
                                   ("p", "2024-03-05", "2024-03-01"), ("q", None, "2024-01-01"), (None, "2024-01-01", "2024-01-01")],
                                  "Project string, first_day string, last_day string")
    merged = coverage.merged_intervals(loads)
    got = sorted((str(r.Project), str(r.first_day), str(r.last_day)) for r in merged.collect())
    assert got == [("None", "2024-01-01", "2024-01-01"), ("p", "2024-01-30", "2024-02-11"), ("p", "2024-05-01", "2024-05-01")]
    days = [("p", "2024-01-29"), ("p", "2024-01-30"), ("p", "2024-02-11"), ("p", "2024-02-12"), ("p", "2024-05-01"), ("q", "2024-01-01"), (None, "2024-01-01"), ("p", None)]
    df = spark.createDataFrame(days, "Project string, day string").withColumn("day", F.to_date("day"))
    assert [r.covered for r in coverage.with_coverage(df, merged).collect()].count(True) == 4
    assert {(r.Project, str(r.day)) for r in coverage.with_coverage(df, merged).filter("covered").collect()} == {
        ("p", "2024-01-30"), ("p", "2024-02-11"), ("p", "2024-05-01"), (None, "2024-01-01")}


def test_orders_outside_the_coverage_stay_unknown(spark):
    facts = spark.createDataFrame([(1, dt.date(2024, 1, d), "a", 5, "P") for d in (1, 2, 3)], "nmId long, day date, name_product string, advertId long, Project string")
    orders = spark.createDataFrame([(1, dt.date(2024, 1, 3), 2, 10.0, 1)], "nmId long, day date, ordersCount int, ordersSumRub double, addToCartCount int")
    cover = coverage.merged_intervals(spark.createDataFrame([("P", "2024-01-02", "2024-01-03")], "Project string, first_day string, last_day string"))
    got = {r.day.day: (r.ordersCount, r.ordersSumRub) for r in ads.ad_orders_fact(facts, orders, coverage=cover).collect()}
    assert got == {1: (None, None), 2: (0, 0.0), 3: (2, 10.0)}
    assert {r.ordersCount for r in ads.ad_orders_fact(facts, orders).collect()} == {0, 2}


# ------------------------------------------------------------------------------------------------ loads
CONTRACT = [("id", "bigint"), ("Project", "string"), ("day", "date")]


def batch(spark, data):
    return spark.createDataFrame([(i, p, dt.date.fromisoformat(d)) for i, p, d in data], "id long, Project string, day date")


def test_append_once_after_a_rerun_and_a_crash(spark, tmp_path, monkeypatch):
    target = writers.once_target(str(tmp_path / "t"), CONTRACT, ["Project", "day"])
    data = [(1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, None, "2024-01-01"), (3, None, "2024-01-01")]
    once = batch(spark, data)
    for _ in range(2):
        writers.append_once(spark, once, target, "l1", "2024-02-01 00:00:00")
        assert writers.read_loaded(spark, target).count() == 4
    units = {(r.load_id, r.unit): r.rows for r in writers.read(spark, writers.ledger_target(target)).collect()}
    assert units == {("l1", '{"Project":"a","day":"2024-01-01"}'): 1, ("l1", '{"Project":"a","day":"2024-01-02"}'): 1, ("l1", '{"Project":null,"day":"2024-01-01"}'): 2}

    def crash(*args):
        raise RuntimeError("driver lost")

    more = batch(spark, [(9, "b", "2024-01-01"), (8, "a", "2024-01-01")])
    with monkeypatch.context() as m:
        m.setattr(writers, "append", crash)  # the rows are written, the ledger is not
        with pytest.raises(RuntimeError):
            writers.append_once(spark, more, target, "l2", "2024-02-01 00:00:00")
    assert writers.read_loaded(spark, target).count() == 4  # not seen
    writers.append_once(spark, more, target, "l2", "2024-02-01 00:00:00")
    assert rows(writers.read_loaded(spark, target), "id") == [(1,), (2,), (3,), (3,), (8,), (9,)]
    writers.append_once(spark, once.limit(0), target, "l3", "2024-02-01 00:00:00")
    assert writers.read_loaded(spark, target).count() == 6


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    target = writers.Target(str(tmp_path / "t"), [("id", "bigint"), ("pad", "string"), ("day", "int")], ("day",))
    writers.create_table(spark, target)
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("int")
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("pad"), day.alias("day"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        writers.append(spark, df, target)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = {d: len([f for f in os.listdir(tmp_path / "t" / d) if f.startswith("part-")]) for d in os.listdir(tmp_path / "t") if d.startswith("day=")}
    assert files["day=0"] >= 4 and sorted(files.values())[len(files) // 2] == 1 and writers.read(spark, target).count() == 60_000


def test_upsert_prunes_the_scan_while_it_runs(spark, tmp_path):
    target = writers.Target(str(tmp_path / "t"), [("k", "bigint"), ("day", "int")], ("day",))
    writers.create_table(spark, target)
    writers.append(spark, spark.range(1_000).selectExpr("id as k", "cast(id % 20 as int) as day"), target)
    touched = writers._touched(spark, target, spark.createDataFrame([(1, 3), (2, 3), (3, 4), (4, None)], "k long, day int"))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert {r.day for r in touched.select("day").distinct().collect()} == {3, 4}


# ------------------------------------------------------------------------------------------------ lossless flattening
def test_variant_leaves_are_those_of_the_wide_form(spark):
    texts = ['{"a":{"b":[1,{"c":"x"}],"e":{}},"f":2.5,"g":"q","h":[[1,2],[3]]}', '{"g":"w","h":[],"n":"v"}', "{}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, js string")
    got = {(r.id, r.path): r.value for r in variant_leaves(docs, "js", keep=["id"]).collect()}
    typed = parse_json_text(docs.filter("id = 1"), "js", "g string, h array<array<int>>, n string")
    wide = {k: v for k, v in recursive_flatten(typed).first().asDict().items() if v is not None}
    assert {p: v for (i, p), v in got.items() if i == 1} == wide
    assert {p: v for (i, p), v in got.items() if i == 0} == {"a_b_0": "1", "a_b_1_c": "x", "f": "2.5", "g": "q", "h_0_0": "1", "h_0_1": "2", "h_1_0": "3"}
    assert not [1 for i, _ in got if i == 2]


def test_variant_leaves_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, "no json"), (3, '{"a":null,"b":"null"}'), (4, "[]"), (5, '["{}"]')], "id int, js string")
    assert {(r.id, r.path, r.value) for r in variant_leaves(docs, "js", keep=["id"]).collect()} == {(3, "a", None), (3, "b", "null"), (5, "0", "{}")}
    wide = spark.createDataFrame([(json.dumps({f"k{i}": i for i in range(20_000)}),)], "js string")
    assert variant_leaves(wide, "js").count() == 20_000
    deep = spark.createDataFrame([('{"a":' * 15 + "1" + "}" * 15,)], "js string")
    with pytest.raises(Exception, match="nested deeper than 12"):
        variant_leaves(deep, "js").collect()
    assert [r.path for r in variant_leaves(deep, "js", max_depth=15).collect()] == ["_".join("a" * 15)]


def test_all_items_keep_every_amount(spark, landed):
    ops = [{"operation_id": "1", "amount": "10.5", "items": [{"name": "x", "sku": "1"}, {"name": "y", "sku": "2"}], "services": [{"name": "s", "price": 2.0}]},
           {"operation_id": "2", "amount": "4", "items": [], "services": [{"name": "t", "price": 1.0}, {"name": "u", "price": 3.0}]},
           {"operation_id": "3", "amount": "1"}]
    got = finance.finance_operations(landed([{"result": {"operations": ops}}], FINANCE_OPERATIONS), project="p", all_items=True)
    assert rows(got, "operation_id", "amount", "item_name", "service_name", "service_price") == sorted([
        (1, 10.5, "x", "s", 2.0), (1, 0.0, "y", None, None), (2, 4.0, None, "t", 1.0), (2, 0.0, None, "u", 3.0), (3, 1.0, None, None, None)],
        key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got.agg(F.sum("amount")).first()[0] == 15.5 and got.agg(F.sum("service_price")).first()[0] == 6.0


# ------------------------------------------------------------------------------------------------ periods and groupings
def test_periods_of_equal_length(spark):
    df = spark.createDataFrame([("a", f"2024-01-{d:02d}", float(v)) for d, v in ((1, 2), (1, 2), (3, 5), (9, 1))] + [("b", "2024-01-04", 3.0)], "k string, day string, v double")
    got = {(r.k, r.day.day): (r.selected, r.previous, r.change) for r in rolling_periods(df, ["k"], "day", "v", 2).collect()}
    assert got == {("a", 1): (4.0, None, None), ("a", 3): (5.0, 4.0, 0.25), ("a", 9): (1.0, None, None), ("b", 4): (3.0, None, None)}
    got = {r.k: (r.selected, r.previous, r.change) for r in selected_and_previous(df, ["k"], "day", "v", "2024-01-03", "2024-01-04").collect()}
    assert got == {"a": (5.0, 4.0, 0.25), "b": (3.0, None, None)}
    with pytest.raises(ValueError):
        selected_and_previous(df, ["k"], "day", "v", "2024-01-03", "2024-01-02")


def test_switches_give_all_groupings_in_one_shuffle(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", "s", 2), ("y", "s", 4)], "brand string, subject string, n long")
    out = regroup_switches(df, {"groupByBrand": "brand", "groupBySubject": "subject"}, counts=["n"])
    got = {(r.groupByBrand, r.groupBySubject, r.brand, r.subject): r.n for r in out.collect()}
    assert got == {(False, False, None, None): 7, (True, False, "x", None): 3, (True, False, "y", None): 4, (False, True, None, None): 1, (False, True, None, "s"): 6,
                   (True, True, "x", None): 1, (True, True, "x", "s"): 2, (True, True, "y", "s"): 4}
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange") == 1

"""Sinks (idempotence, by-name binding, truncate, exports) and the incremental order stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F


from conftest import rows
from marketlens import schemas
from marketlens.plans import orders
from marketlens.sinks import writers
from marketlens.streaming.incremental import orders_stream

CONTRACT = [("id", "bigint"), ("v", "double"), ("day", "date")]


def frame(spark, data):
    return spark.createDataFrame([(i, v, dt.date.fromisoformat(d)) for i, v, d in data], "id bigint, v double, day date")


def test_reload_window_idempotent_and_clears_missing_days(spark, tmp_path):
    t = writers.Target(str(tmp_path / "t"), CONTRACT, ("day",))
    writers.create_table(spark, t)
    writers.append(spark, frame(spark, [(1, 1.0, "2024-01-01"), (2, 2.0, "2024-01-02"), (3, 3.0, "2024-01-03"),
                                        (4, 4.0, "2024-01-04")]), t)
    new = frame(spark, [(22, 20.0, "2024-01-02"), (99, 9.0, "2024-01-09")])  # 01-03 absent; 01-09 outside
    for _ in range(2):
        writers.reload_window(spark, new, t, "2024-01-02", "2024-01-03")
        got = rows(writers.read(spark, t), "id", "day")
        assert got == [(1, dt.date(2024, 1, 1)), (22, dt.date(2024, 1, 2)), (4, dt.date(2024, 1, 4))]


def test_upsert_twice_equals_once(spark, tmp_path):
    t = writers.Target(str(tmp_path / "u"), [("k", "bigint"), ("ver", "int"), ("v", "string"), ("b", "int")], ("b",))
    writers.create_table(spark, t)
    batch = spark.createDataFrame([(1, 1, "a", 0), (1, 2, "b", 0), (2, 1, "c", 1), (2, 1, "d", 1)],
                                  "k bigint, ver int, v string, b int")
    writers.upsert_latest(spark, batch, t, ["k"], "ver")
    once = rows(writers.read(spark, t))
    writers.upsert_latest(spark, batch, t, ["k"], "ver")
    assert rows(writers.read(spark, t)) == once == [(1, 2, "b", 0), (2, 1, "d", 1)]
    older = spark.createDataFrame([(1, 0, "old", 0)], "k bigint, ver int, v string, b int")
    writers.upsert_latest(spark, older, t, ["k"], "ver")
    assert rows(writers.read(spark, t)) == once  # an older version never wins


def test_backfill_binds_by_name_and_truncate(spark, tmp_path):
    t = writers.Target(str(tmp_path / "b"), [("b", "string"), ("a", "string"), ("zero", "int"), ("ts", "timestamp_ntz")])
    writers.create_table(spark, t)
    src = spark.createDataFrame([("A1", "B1", dt.datetime(2024, 2, 28, 23, 59, 59)),
                                 ("A2", "B2", dt.datetime(2024, 2, 29, 0, 0))], "a string, b string, ts timestamp_ntz")
    writers.backfill_with_default(spark, src, t, "ts", "2024-02-28", {"zero": 0})
    assert rows(writers.read(spark, t)) == [("B1", "A1", 0, dt.datetime(2024, 2, 28, 23, 59, 59))]
    writers.create_table(spark, t)  # IF NOT EXISTS: leaves data alone
    assert writers.read(spark, t).count() == 1
    writers.truncate(spark, t)
    assert writers.read(spark, t).count() == 0 and writers.read(spark, t).columns == ["b", "a", "zero", "ts"]


def test_exports_keep_utf8(spark, tmp_path):
    df = spark.createDataFrame([("Кружка", 1)], "name string, n int")
    writers.dump_json(df, str(tmp_path / "j"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("part-*"))
    assert "Кружка" in text and json.loads(text.strip())["name"] == "Кружка"
    writers.export_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert rows(back) == [("Кружка", "1")]


def test_orders_stream_catch_up_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target = orders.orders_target(str(tmp_path / "orders_wb"))
    writers.create_table(spark, target)
    ckpt = str(tmp_path / "stream-ckpt")

    def land(name, recs):
        (landing / name).write_text("\n".join(json.dumps(r) for r in recs))

    base = {"date": "2024-03-01T10:00:00", "nmId": 1, "srid": "s1", "totalPrice": 100.0}
    land("p1.json", [{**base, "lastChangeDate": "2024-03-01T12:00:00"},
                     {**base, "srid": "s2", "lastChangeDate": "2024-03-01T12:00:00"}])
    q = orders_stream(spark, str(landing), target, ckpt, project="P1", multi_line=False)
    q.awaitTermination(120)
    assert writers.read(spark, target).count() == 2
    land("p2.json", [{**base, "lastChangeDate": "2024-03-02T08:00:00", "totalPrice": 80.0}])
    q = orders_stream(spark, str(landing), target, ckpt, project="P1", multi_line=False)
    q.awaitTermination(120)
    got = {r.srid: r.totalPrice for r in writers.read(spark, target).collect()}
    assert got == {"s1": 80.0, "s2": 100.0}  # p1.json was not read again; s1 took its newer version
    assert writers.read(spark, target).columns[:30] == schemas.names(schemas.ORDERS_WB)


def test_catalog_registration_sees_partitions(spark, tmp_path):
    t = writers.Target(str(tmp_path / "cat"), CONTRACT, ("day",))
    writers.create_table(spark, t)
    writers.append(spark, frame(spark, [(1, 1.0, "2024-01-01"), (2, 2.0, "2024-01-02")]), t)
    writers.register_catalog_table(spark, t, "ml_test_cat")
    got = spark.sql("SELECT id, day FROM ml_test_cat WHERE day = DATE'2024-01-02'").collect()
    assert [tuple(r) for r in got] == [(2, dt.date(2024, 1, 2))]
    assert [c.name for c in spark.catalog.listColumns("ml_test_cat") if c.isPartition] == ["day"]


def test_upsert_merges_rows_under_a_null_partition(spark, tmp_path):
    t = writers.Target(str(tmp_path / "n"), [("k", "bigint"), ("ver", "int"), ("day", "date")], ("day",))
    writers.create_table(spark, t)
    first = spark.createDataFrame([(1, 1, None), (2, 1, dt.date(2024, 1, 1))], "k bigint, ver int, day date")
    writers.upsert_latest(spark, first, t, ["k", "day"], "ver")
    second = spark.createDataFrame([(1, 2, None)], "k bigint, ver int, day date")
    writers.upsert_latest(spark, second, t, ["k", "day"], "ver")
    assert rows(writers.read(spark, t)) == [(1, 2, None), (2, 1, dt.date(2024, 1, 1))]


def test_orders_stream_reads_multi_line_pages(spark, tmp_path):
    landing = tmp_path / "pages"
    landing.mkdir()
    page = [{"date": "2024-03-01T10:00:00", "nmId": 1, "srid": s, "totalPrice": 1.5, "lastChangeDate": "2024-03-01T12:00:00"} for s in "ab"]
    (landing / "p1.json").write_text(json.dumps(page, indent=2))
    target = orders.orders_target(str(tmp_path / "orders_pages"))
    writers.create_table(spark, target)
    orders_stream(spark, str(landing), target, str(tmp_path / "ckpt-pages"), project="P1").awaitTermination(120)
    assert sorted((r.srid, r.totalPrice) for r in writers.read(spark, target).collect()) == [("a", 1.5), ("b", 1.5)]


def test_upsert_keeps_stored_rows_for_any_partition_type(spark, tmp_path):
    for n, (kind, value) in enumerate([("timestamp_ntz", "2024-01-01 00:00:00"), ("timestamp_ntz", "2024-01-01 10:30:00"), ("string", "a b/c=d"), ("int", "7"),
                                       ("date", "2024-01-01"), ("string", None)]):
        t = writers.Target(str(tmp_path / f"up{n}"), [("k", "int"), ("v", "int"), ("day", kind)], ("day",))
        writers.create_table(spark, t)
        for k in (1, 2, 1):
            df = spark.createDataFrame([(k, k * 10)], "k int, v int").withColumn("day", F.lit(value).cast(kind))
            writers.upsert_latest(spark, df, t, ["k"], "v")
        assert sorted((r.k, r.v) for r in writers.read(spark, t).collect()) == [(1, 10), (2, 20)], (kind, value)


def test_unreadable_table_is_not_taken_for_an_empty_one(spark, tmp_path):
    t = writers.Target(str(tmp_path / "none"), [("k", "int"), ("day", "date")], ("day",))
    assert writers._stored(spark, t).count() == 0
    bad = writers.Target(str(tmp_path / "none"), [("k", "no_such_type"), ("day", "date")], ("day",))
    with pytest.raises(Exception):
        writers._stored(spark, bad)

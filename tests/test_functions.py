"""Scalar functions (SCA-*): nulls, bad text, unknown codes, offsets, sentinels."""

import datetime as dt

from pyspark.sql import functions as F

from marketlens.functions import clean, dates, labels


def one(spark, expr, ddl="c string", values=(None,)):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_label_or_code_keeps_unknown(spark):
    out = one(spark, clean.label_or_code("c", labels.CAMPAIGN_STATUS), "c int", [9, 5, None, -1])
    assert out == ["Идут показы", "5", None, "Кампания в процессе удаления"]


def test_label_or_null_drops_unknown(spark):
    out = one(spark, clean.label_or_null("c", labels.CAMPAIGN_STATE), "c string",
              ["CAMPAIGN_STATE_RUNNING", "SOMETHING_NEW", None])
    assert out == ["активная кампания", None, None]


def test_tolerant_numbers(spark):
    vals = ["12.7", "-3.9", "abc", "", None, "7", " 8 "]
    assert one(spark, clean.to_double("c"), values=vals) == [12.7, -3.9, None, None, None, 7.0, 8.0]
    # fraction truncated (not rounded), bad text and null become 0
    assert one(spark, clean.to_long_or_zero("c"), values=vals) == [12, -3, 0, 0, 0, 7, 8]
    assert one(spark, clean.to_double_or_zero("c"), values=vals) == [12.7, -3.9, 0.0, 0.0, 0.0, 7.0, 8.0]


def test_nan_text_counts_as_not_a_number(spark):
    assert one(spark, clean.to_double("c"), values=["NaN"]) == [None]
    assert one(spark, clean.to_double_or_zero("c"), values=["NaN"]) == [0.0]


def test_tolerant_doubles_skips_absent_columns(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    out = clean.tolerant_doubles(df, ["a", "b", "missing"])
    assert out.columns == ["a", "b"]
    assert tuple(out.first()) == (1.5, None)


def test_wall_clock_drops_offset_near_midnight(spark):
    vals = ["2024-03-01T23:30:00+03:00", "2024-03-01T00:10:00Z", "not a date", None]
    out = one(spark, clean.to_wall_clock("c"), values=vals)
    assert out[:2] == [dt.datetime(2024, 3, 1, 23, 30), dt.datetime(2024, 3, 1, 0, 10)]
    assert out[2:] == [None, None]
    days = one(spark, F.to_date(clean.to_wall_clock("c")), values=vals[:1])
    assert days == [dt.date(2024, 3, 1)]  # not shifted to the UTC day


def test_parse_formats_mixed(spark):
    vals = ["2024-01-05T10:00:00.123+03:00", "05.01.2024", "2024/01/06", "garbage"]
    out = one(spark, F.to_date(clean.parse_timestamp_formats("c", ["dd.MM.yyyy", "yyyy/MM/dd"])), values=vals)
    assert out == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 6), None]


def test_sentinel_for_missing_and_out_of_range_dates(spark):
    vals = [None, "bad", "0001-01-01T00:00:00", "2024-02-03T04:05:06"]
    out = one(spark, clean.date_or_sentinel("c"), values=vals)
    assert out == [dt.datetime(2100, 1, 1)] * 3 + [dt.datetime(2024, 2, 3, 4, 5, 6)]


def test_empty_strings_to_null_and_nan(spark):
    df = spark.createDataFrame([("", "a", float("nan")), ("b", "", 1.0)], "x string, y string, z double")
    out = clean.empty_strings_to_null(df, ["x"]).withColumn("z", clean.nan_to_null("z"))
    assert [tuple(r) for r in out.collect()] == [(None, "a", None), ("b", "", 1.0)]


def test_fill_upper_bool(spark):
    df = spark.createDataFrame([(None, None, None), (1, "брэнд", True)], "n int, b string, f boolean")
    out = clean.fill_zero(df, ["n"]).select("n", clean.upper_or_empty("b").alias("u"),
                                            clean.upper_keep_null("b").alias("k"), clean.bool_to_int("f").alias("i"))
    assert [tuple(r) for r in out.collect()] == [(0, "", None, None), (1, "БРЭНД", "БРЭНД", 1)]


def test_map_and_join_keeps_unknown_elements(spark):
    df = spark.createDataFrame([(["PLACEMENT_PDP", "NEW_ONE"],), ([],)], "a array<string>")
    out = [r[0] for r in df.select(clean.map_and_join("a", labels.PLACEMENT)).collect()]
    assert out == ["карточка товара, NEW_ONE", ""]


def test_text_after_last_marker(spark):
    vals = ["https://x/app/#good/edit?id=abc-1", "no marker", "ends with id=", None, "", "a id=1 id=2"]
    assert one(spark, clean.text_after_last("c", "id="), values=vals) == ["abc-1", "no marker", "", None, None, "2"]


def test_status_label_and_default(spark):
    out = one(spark, clean.status_label("c", 200, "Successful", "Error"), "c int", [200, 429, None])
    assert out == ["Successful", "Error", "Error"]
    assert one(spark, clean.with_default("c", "x"), values=[None, "y"]) == ["x", "y"]


def test_date_helpers(spark):
    d = "c date"
    day = [dt.date(2025, 5, 3)]
    assert one(spark, dates.unpadded_date_text("c"), d, day) == ["2025-5-3"]
    assert one(spark, dates.previous_week_start("c"), d, day) == [dt.date(2025, 4, 21)]
    assert one(spark, dates.previous_week_end("c"), d, day) == [dt.date(2025, 4, 27)]
    assert one(spark, dates.day_start_text("c"), d, day) == ["2025-05-03 00:00:00"]
    assert one(spark, dates.day_end_text("c"), d, day) == ["2025-05-03 23:59:59"]
    assert one(spark, dates.iso_utc_text("c"), d, day) == ["2025-05-03T00:00:00.000Z"]
    assert one(spark, dates.year_start("c"), d, day) == [dt.date(2025, 1, 1)]
    assert dates.reload_days("2025-05-10", 6) == (dt.date(2025, 5, 4), dt.date(2025, 5, 9))
    cal = [r.day for r in dates.calendar(spark, "2025-05-03", 3).collect()]
    assert cal == [dt.date(2025, 5, 1), dt.date(2025, 5, 2), dt.date(2025, 5, 3)]

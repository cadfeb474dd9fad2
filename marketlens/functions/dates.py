"""Date helpers (SCA-8, SCA-9, SCA-19 to SCA-23). "Now" is always a parameter, never read from the clock
inside a transformation, so reruns and tests are reproducible."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# SCA-8: truncate to date.
def day_of(c) -> Column:
    return F.to_date(_c(c))


# SCA-9: date to timestamp for the sink.
def day_as_timestamp(c) -> Column:
    return _c(c).cast("timestamp_ntz")


# SCA-19: unpadded Y-M-D text.
def unpadded_date_text(c) -> Column:
    return F.date_format(_c(c), "y-M-d")


# SCA-20: year, month, day parts.
def date_parts(c) -> dict[str, Column]:
    c = _c(c)
    return {"year": F.year(c), "month": F.month(c), "day_of_month": F.dayofmonth(c)}


# SCA-21: formatted request bounds.
def day_start_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd 00:00:00")


def day_end_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd 23:59:59")


def iso_utc_text(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def year_start(c) -> Column:
    return F.trunc(_c(c), "year")


# SCA-22: previous calendar week, Monday to Sunday.
def previous_week_start(c) -> Column:
    return F.date_sub(F.trunc(_c(c), "week"), 7)


def previous_week_end(c) -> Column:
    return F.date_sub(F.trunc(_c(c), "week"), 1)


# SCA-23: day sequences as a calendar frame.
def calendar(spark: SparkSession, end: dt.date | str, days: int, column: str = "day") -> DataFrame:
    """``days`` consecutive dates ending at ``end`` (inclusive), one row each, built by Spark."""
    end_c = F.lit(str(end)).cast("date")
    return (spark.range(1).select(F.explode(F.sequence(F.date_sub(end_c, days - 1), end_c)).alias(column)))


def reload_days(today: dt.date | str, days: int = 6) -> tuple[dt.date, dt.date]:
    """The reload window: ``days`` days ending yesterday, as (first, last)."""
    t = today if isinstance(today, dt.date) else dt.date.fromisoformat(str(today))
    last = t - dt.timedelta(days=1)
    return last - dt.timedelta(days=days - 1), last

"""Filters and predicates (FLT-1 to FLT-11). Plain column predicates, so Catalyst pushes them into the
Parquet scan and prunes ``day``/``project`` partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import to_double, to_wall_clock


def equals(df: DataFrame, column: str, value) -> DataFrame:  # FLT-1, FLT-2
    return df.filter(F.col(column) == F.lit(value))


def out_of_stock(df: DataFrame, stock_col: str) -> DataFrame:
    """FLT-3: numeric-coerced stock equal to 0; unparseable or null stock is excluded."""
    return df.filter(to_double(stock_col) == 0)


def falling_sales(df: DataFrame, ordered_col: str, change_col: str, min_ordered: float = 5,
                  max_change: float = -0.5) -> DataFrame:
    """FLT-4: ordered above ``min_ordered`` and change below ``max_change``."""
    return df.filter((F.col(ordered_col) > min_ordered) & (F.col(change_col) < max_change))


def on_or_after(df: DataFrame, column: str, bound: str) -> DataFrame:
    """FLT-5: ISO text compares like the date it spells, so a string ``>=`` is a date compare."""
    return df.filter(F.col(column) >= F.lit(bound))


def valid_timestamps(df: DataFrame, column: str) -> DataFrame:
    """FLT-6: parse tolerantly, then drop rows whose value is not a timestamp."""
    return df.withColumn(column, to_wall_clock(column)).filter(F.col(column).isNotNull())


def day_between(df: DataFrame, column: str, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """FLT-7/FLT-9: inclusive day range; on a ``day`` partition column this prunes partitions."""
    return df.filter(F.col(column).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))


def up_to_day_end(df: DataFrame, column: str, last: dt.date | str) -> DataFrame:
    """FLT-7 upper bound ``<= 'last 23:59:59'`` (the whole last day)."""
    bound = F.lit(f"{last} 23:59:59").cast("timestamp_ntz")
    return df.filter(F.col(column).cast("timestamp_ntz") <= bound)


def year_at_least(df: DataFrame, column: str, year: int | None) -> DataFrame:
    """FLT-8: optional; ``None`` keeps every row."""
    return df if year is None else df.filter(F.year(F.col(column)) >= year)


def successful_payloads(df: DataFrame, payload_col: str, error_col: str | None = "error") -> DataFrame:
    """FLT-10: skip failed or empty payloads (error flag set, payload missing or empty)."""
    cond: Column = F.col(payload_col).isNotNull()
    if error_col and error_col in df.columns:
        cond = cond & ~F.coalesce(F.col(error_col).cast("boolean"), F.lit(False))
    return df.filter(cond)


def after_high_water_mark(df: DataFrame, column: str, hwm, inclusive: bool = True) -> DataFrame:
    """FLT-11: rows at or after the last seen value. ``>=`` is the default for timestamps, where ties are
    possible; the duplicate boundary rows are removed by ``latest_version``."""
    if hwm is None:
        return df
    c = F.col(column)
    return df.filter(c >= F.lit(hwm) if inclusive else c > F.lit(hwm))


def after_group_mark(df: DataFrame, marks: DataFrame, group: str, column: str) -> DataFrame:
    """FLT-11 with a mark for each group (``marks``: ``group``, ``mark``; a row a group): rows at or after their own group's mark.
    Rows of a group without a mark, and rows whose ``column`` is null, are kept."""
    own = marks.select(F.col(group).alias("__group"), "mark")
    return (df.join(own, F.col(group).eqNullSafe(F.col("__group")), "left")
            .filter(F.col("mark").isNull() | F.col(column).isNull() | (F.col(column) >= F.col("mark"))).drop("__group", "mark"))

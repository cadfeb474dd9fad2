"""Coverage of loads (JON-2 with SCA-13): a day without a row means 0 only where the day was landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged_intervals(loads: DataFrame, keys: Sequence[str] = ("Project",), first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Disjoint intervals of days (``keys``, ``first_day``, ``last_day``) that the loads of each group cover; adjoining ones are joined.

    A sweep by first day with the running maximum of the last: one row for each distinct interval requested, so a window holds the
    load history of one group. Intervals with a null or reversed end cover nothing.
    """
    rows = loads.select(*keys, F.col(first).cast("date").alias("first_day"), F.col(last).cast("date").alias("last_day")).filter(
        "first_day <= last_day").distinct()
    w = Window.partitionBy(*keys).orderBy("first_day", "last_day")
    reached = F.max("last_day").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("__new", F.coalesce(F.col("first_day") > F.date_add(reached, 1), F.lit(True)).cast("int"))
    return (opened.withColumn("__island", F.sum("__new").over(w)).groupBy(*keys, "__island")
            .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).drop("__island"))


def with_coverage(df: DataFrame, coverage: DataFrame, keys: Sequence[str] = ("Project",), day: str = "day", column: str = "covered") -> DataFrame:
    """``df`` with a boolean column: whether its day lies in an interval of its group. ``coverage`` as from ``merged_intervals``.

    An interval join on equality of group and month (an interval has a row for each month it touches) and the day between its
    ends: a fact meets the few intervals of its own month, and a group's months are separate join keys. At most one interval fits, so no row doubles.
    """
    months = F.sequence(F.trunc("first_day", "month"), F.trunc("last_day", "month"), F.expr("interval 1 month"))
    binned = coverage.select(*[F.col(k).alias(f"__c_{k}") for k in keys], "first_day", "last_day", F.explode(months).alias("__month"))
    d = F.to_date(F.col(day))
    meets = (F.trunc(d, "month") == F.col("__month")) & d.between(F.col("first_day"), F.col("last_day"))
    for k in keys:
        meets = meets & F.col(k).eqNullSafe(F.col(f"__c_{k}"))
    joined = df.join(binned, meets, "left")
    return joined.select(*df.columns, F.col("first_day").isNotNull().alias(column))

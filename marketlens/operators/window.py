"""Version and period operators (WIN-1, WIN-2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, key: Sequence[str], version: str,
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """WIN-1: one row per key, the one with the highest ``version``; ties go to the highest values of
    ``tiebreak`` (default: every other column, in frame order), so the winner is deterministic.

    Written as ``max(struct(version, tiebreak..., rest...))`` per key rather than ``row_number`` over a
    window: it is a decomposable aggregate, so each map task keeps only its local winner per key and a key
    holding a third of the rows is pre-reduced before the shuffle instead of sorted in one task.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key and c != version]
    order = list(tiebreak) if tiebreak is not None else rest
    payload = [version, *order, *[c for c in rest if c not in order]]
    packed = df.groupBy(*key).agg(F.max(F.struct(*payload)).alias("__v"))
    return packed.select(*[F.col(c) if c in key else F.col(f"__v.{c}").alias(c) for c in df.columns])


def period_change(df: DataFrame, entity: Sequence[str], period: str, value: str,
                  previous_period: Callable[[Column], Column], digits: int = 6) -> DataFrame:
    """WIN-2: ``change = value / previous - 1`` against the immediately preceding period of the same entity.

    ``df`` has one row per (entity, period). The previous value is null when that period has no row or
    its value is 0 (a gap is not bridged to an older period). The window holds one row per period of one
    entity, so its size is bounded by the calendar, not by the data volume.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    prev_p = F.lag(period).over(w)
    prev_v = F.lag(value).over(w)
    out = df.withColumn("prev_" + value, F.when(prev_p == previous_period(F.col(period)), prev_v))
    prev = F.col("prev_" + value)
    return out.withColumn("change", F.round(F.when(prev != 0, F.col(value) / prev - 1), digits))


def rolling_periods(df: DataFrame, entity: Sequence[str], day: str, value: str, n_days: int, digits: int = 6) -> DataFrame:
    """WIN-2 for every day: the sum of ``value`` over the ``n_days`` days that end on it, over the ``n_days`` before those, and the change.

    ``df`` is reduced to a row for each entity and day first, so a window holds one entity's days whatever its rows. The frames are
    ranges of days, not of rows: a gap counts as no sales and is not bridged. A period without any row is null, and so is the change.
    """
    daily = df.groupBy(*entity, F.to_date(day).alias(day)).agg(F.sum(F.col(value).cast("decimal(38,10)")).alias("__v"))
    w = Window.partitionBy(*entity).orderBy(F.unix_date(day))
    now, before = F.sum("__v").over(w.rangeBetween(-(n_days - 1), 0)), F.sum("__v").over(w.rangeBetween(-(2 * n_days - 1), -n_days))
    sums = daily.select(*entity, day, now.cast("double").alias("selected"), before.cast("double").alias("previous"))
    return sums.withColumn("change", _change(digits))


def selected_and_previous(df: DataFrame, entity: Sequence[str], day: str, value: str, begin: dt.date | str, end: dt.date | str,
                          digits: int = 6) -> DataFrame:
    """WIN-2 for one selected period ``begin`` to ``end`` against the one of equal length right before it, for each entity with a row in either.

    Both sums are taken in one aggregation; days outside both are not read further. A period without any row is null."""
    first, last = (d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in (begin, end))
    if last < first:
        raise ValueError("the period ends before it begins")
    start = first - (last - first) - dt.timedelta(days=1)
    d, v = F.to_date(day), F.col(value).cast("decimal(38,10)")
    from_, mid, to = (F.lit(str(x)).cast("date") for x in (start, first, last))
    return (df.filter(d.between(from_, to)).groupBy(*entity).agg(
        F.sum(F.when(d >= mid, v)).cast("double").alias("selected"), F.sum(F.when(d < mid, v)).cast("double").alias("previous"))
        .withColumn("change", _change(digits)))


def _change(digits: int) -> Column:
    return F.round(F.when(F.col("previous") != 0, F.col("selected") / F.col("previous") - 1), digits)

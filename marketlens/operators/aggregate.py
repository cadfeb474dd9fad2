"""Aggregations (AGG-1 to AGG-10).

Every aggregate here is decomposable (sum, count, min/max of a struct, min_by), so Spark runs a partial
aggregate before the shuffle and a final one after it: a hot key is pre-combined on every map task and
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_of


# Decimal places that a summed value keeps; a value is rounded to them before the sum, so a sum of n values is within n * 0.5e-10 of the exact one.
SUM_SCALE = 10


def exact_decimal(c: str | Column, scale: int = SUM_SCALE) -> Column:
    """The value as a decimal(38, scale), for sums that do not depend on the order of the rows."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal(38,{scale})")


def exact_sum(c: str | Column, scale: int = SUM_SCALE) -> Column:
    """Order-independent sum: values as decimals, returned as double. A double sum depends on row order (hence on partitioning)."""
    return F.sum(exact_decimal(c, scale)).cast("double")


def sum_or_zero(c: str | Column) -> Column:
    """pandas semantics: the sum of an all-null group is 0, not null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def money_sum_or_zero(c: str | Column, scale: int = SUM_SCALE) -> Column:
    return F.coalesce(exact_sum(c, scale), F.lit(0.0))


def mean_rounded(c: str | Column, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.avg(c), digits)


def first_non_null(c: str, order_cols: Sequence[str]) -> Column:
    """pandas ``first`` made order-free: the non-null value at the lowest ``order_cols``, ties broken by the
    value itself. ``min_by`` ignores rows whose ordering is null, which is how nulls are skipped."""
    v = F.col(c)
    return F.min_by(v, F.when(v.isNotNull(), F.struct(*[F.col(o) for o in order_cols], v)))


# Metrics of the daily ad fact and how each is combined.
AD_SUM_METRICS = ["views", "clicks", "atbs", "orders", "shks"]
AD_MONEY_METRICS = ["sum", "sum_price"]
AD_MEAN_METRICS = ["ctr", "cpc", "cr"]


def daily_ad_fact(flat: DataFrame, keys: Sequence[str] = ("Project", "Marketplace"),
                  order_cols: Sequence[str] = ("date",), money_scale: int = SUM_SCALE,
                  mean_digits: int = 6, ratio_of_sums: bool = False) -> DataFrame:
    """AGG-1: group flat ad statistics by (keys, day of ``date``, nmId, advertId).

    Sums of counts and money (0 when all null), rounded means of the three ratios, first ``date`` and
    first ``name``. Rows with a null group key are dropped first, as pandas ``groupby`` does.
    The mean of per-row ratios is kept for parity; ``ratio_of_sums=True`` adds ``ctr_of_sums`` =
    clicks / views * 100 from the sums (null when there are no views), the ratio a reader usually means.
    """
    group = [*keys, "day", "nmId", "advertId"]
    src = flat.withColumn("day", day_of("date")).dropna(subset=group)
    aggs = [F.min("date").alias("date"), first_non_null("name", order_cols).alias("name")]
    aggs += [sum_or_zero(m).alias(m) for m in AD_SUM_METRICS]
    aggs += [money_sum_or_zero(m, money_scale).alias(m) for m in AD_MONEY_METRICS]
    aggs += [mean_rounded(m, mean_digits).alias(m) for m in AD_MEAN_METRICS]
    out = src.groupBy(*group).agg(*aggs)
    cols = [*group, "date", "name", "views", "clicks", "sum", "atbs", "orders", "shks", "sum_price", "ctr", "cpc", "cr"]
    if ratio_of_sums:
        out = out.withColumn("ctr_of_sums", F.round(F.try_divide(F.col("clicks") * 100.0, F.nullif("views", F.lit(0))),
                                                    mean_digits))
        cols.append("ctr_of_sums")
    return out.select(*cols)


# AGG-2 / AGG-3: global and filtered sums, one row.
def total(df: DataFrame, column: str, alias: str, money_scale: int | None = None) -> DataFrame:
    agg = exact_sum(column, money_scale) if money_scale is not None else F.sum(column)
    return df.agg(agg.alias(alias))


def filtered_total(df: DataFrame, column: str, condition: Column, alias: str,
                   money_scale: int | None = None) -> DataFrame:
    return total(df.filter(condition), column, alias, money_scale)


# AGG-4: exact distinct count (null not counted).
def distinct_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(alias))


# AGG-5 / AGG-6: distinct values.
def distinct_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()


# AGG-9 / AGG-10: regroup finer rows to a coarser key with sums.
def regroup_sum(df: DataFrame, keys: Sequence[str | Column], counts: Sequence[str] = (),
                money: Sequence[str] = (), money_scale: int = SUM_SCALE, row_count: str | None = None,
                keep_decimal: bool = False) -> DataFrame:
    """Sum counts (0 for all-null) and money (decimal) per key. ``keep_decimal`` leaves money sums as
    decimals so a later regroup of these partial sums is still exact; cast to double at the last stage."""
    aggs = [sum_or_zero(c).alias(c) for c in counts]
    if keep_decimal:
        aggs += [F.sum(F.col(c).cast(f"decimal(38,{money_scale})")).alias(c) for c in money]
    else:
        aggs += [money_sum_or_zero(c, money_scale).alias(c) for c in money]
    if row_count:
        aggs.append(F.count(F.lit(1)).alias(row_count))
    return df.groupBy(*keys).agg(*aggs)


def regroup_switches(df: DataFrame, switches: dict[str, str], counts: Sequence[str] = (), money: Sequence[str] = ()) -> DataFrame:
    """AGG-9 for every subset of the switches at once: ``switches`` maps a switch (``groupByBrand``) to the column that it groups by.

    GROUPING SETS over all subsets: the rows are read and shuffled once (a partial aggregate for each set before the shuffle). A row
    tells by its switches (booleans) which grouping it belongs to; a column that is not grouped by is null, as it may also be in the data.
    """
    columns = list(switches.values())
    sets = [[c for k, c in enumerate(columns) if mask >> k & 1] for mask in range(1 << len(columns))]
    aggs = [sum_or_zero(c).alias(c) for c in counts] + [money_sum_or_zero(c).alias(c) for c in money]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        *[(F.grouping(c) == 0).alias(s) for s, c in switches.items()], *aggs)
    return grouped.select(*switches, *columns, *counts, *money)

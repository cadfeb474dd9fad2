"""Advertising jobs (JOB-1 to JOB-7): campaign dimension, daily ad fact, attribution of product orders.

Plan shape of the full job (``ad_orders_fact``): Parquet/JSON scan -> Generate x3 (narrow) -> partial
aggregate -> shuffle on the fact key -> final aggregate -> left join with the campaign dimension (broadcast
when AQE measures it small) -> left join with product-day orders (sort-merge on (nmId, day), or broadcast
when AQE measures that side small) -> projection. Two shuffles for the facts; everything else is narrow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.clean import fill_zero, label_or_code, parse_timestamp_formats, to_wall_clock
from ..functions.dates import day_as_timestamp, reload_days
from ..operators.aggregate import daily_ad_fact
from ..operators.coverage import with_coverage
from ..operators.filters import year_at_least
from ..operators.flatten import explode_positions, explode_with_meta, select_paths
from ..operators.joins import left_join, restrict_to_keys
from ..operators.project import conform, typed
from ..schemas import (AD_STATS_NM, CAMPAIGN_DATA_WB, CAMPAIGN_DATA_WB_PERIOD, CAMPAIGN_DETAIL_FIELDS,
                       PRODUCT_HISTORY_DAY, flat_types)
from ..sinks import writers

# The tenant columns, and the product-day order metrics attached to the ad fact.
TENANT = ("Project", "Marketplace")
ORDER_METRICS = ["ordersCount", "ordersSumRub", "addToCartCount"]

# Non-ISO time shapes accepted besides ISO text (ISO, with or without fraction or offset, is tried first).
CAMPAIGN_TIME_FORMATS = ["dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd"]


# ------------------------------------------------------------------------------------------- JOB-2
def campaign_list(counts: DataFrame, keep: Sequence[str] = TENANT, min_year: int | None = None) -> DataFrame:
    """PRJ-1: ``adverts[]{type,status,count,advert_list[]}`` -> one row per advert with its group's
    type, status and count, and ``changeTime`` parsed; optionally only adverts changed in ``min_year`` or
    later (FLT-8)."""
    groups = explode_with_meta(counts, "adverts", keep=[c for c in keep if c in counts.columns])
    ids = explode_with_meta(groups, "advert_list", meta=["type", "status", "count"],
                            keep=[c for c in keep if c in groups.columns])
    ids = typed(ids, [("type", "int"), ("status", "int"), ("count", "int"), ("advertId", "bigint")])
    return year_at_least(ids.withColumn("changeTime", to_wall_clock("changeTime")), "changeTime", min_year)


def campaign_dim(details: DataFrame, status_labels: Mapping = labels.CAMPAIGN_STATUS,
                 type_labels: Mapping = labels.CAMPAIGN_TYPE, listed: DataFrame | None = None) -> DataFrame:
    """JOB-2: campaign details -> dimension (advertId, dates, name, labelled status and type, tenant).

    Dates are parsed over several formats and truncated to the day (SCA-6/8); codes become labels with
    unknown codes kept (SCA-1). ``listed`` (from ``campaign_list``) restricts to listed adverts (JON-6).
    """
    if listed is not None:
        details = restrict_to_keys(details, listed, ["advertId"])
    tenant = [c for c in TENANT if c in details.columns]
    if "advertId" in details.columns and dict(details.dtypes).get("status") == "string":  # as landed
        details = typed(details, flat_types(CAMPAIGN_DETAIL_FIELDS))
    return details.select(
        *[F.to_date(parse_timestamp_formats(c, CAMPAIGN_TIME_FORMATS)).alias(c)
          for c in ("endTime", "createTime", "startTime")],
        "name", "advertId",
        label_or_code("status", status_labels).alias("status"),
        label_or_code("type", type_labels).alias("type"),
        *tenant)


# ------------------------------------------------------------------------------------------- JOB-1
def flatten_ad_stats(stats: DataFrame, keep: Sequence[str] = TENANT) -> DataFrame:
    """PRJ-3: ``{advertId, days[]{date, apps[]{appType, nm[]{12 metrics}}}}`` -> one row per product,
    app and day: the 12 metrics, ``date`` (wall clock, offset dropped: SCA-7) and ``advertId``, plus the
    app and product positions used for an order-free "first". A record ``{}`` gives no rows."""
    keep = [c for c in keep if c in stats.columns]
    days = explode_with_meta(stats, "days", meta=["advertId"], keep=keep)
    apps = explode_positions(days, "apps", "app_pos", [*keep, "advertId", "date"])
    nms = explode_positions(apps, "nm", "nm_pos", [*keep, "advertId", "date", "app_pos", "appType"])
    nms = typed(nms, [("advertId", "bigint"), *flat_types(AD_STATS_NM)])
    return nms.withColumn("date", to_wall_clock("date"))


def ad_daily_fact(flat_stats: DataFrame, order_cols: Sequence[str] = ("date", "app_pos", "nm_pos")) -> DataFrame:
    """JOB-1 (AGG-1): daily fact per tenant, day, product and campaign."""
    order = [c for c in order_cols if c in flat_stats.columns]
    return daily_ad_fact(flat_stats, keys=[c for c in TENANT if c in flat_stats.columns], order_cols=order)


# ------------------------------------------------------------------------------------------- JOB-6
def ad_facts_with_campaign(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """JON-1 + PRJ-13/14: facts LEFT JOIN campaign dimension on ``advertId``; the per-row ratios are
    dropped and the two ``name`` columns are renamed before the join (not suffixed after it)."""
    f = facts.drop("ctr", "cpc", "cr").withColumnRenamed("name", "name_product")
    d = dim.select("advertId", "endTime", "createTime", "startTime", F.col("name").alias("name_campaign"),
                   "status", "type")
    return left_join(f, d, ["advertId"])


def ad_period_fact(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """JOB-6: ad facts with campaign attributes in the 19-column period contract."""
    return conform(ad_facts_with_campaign(facts, dim).withColumn("day", day_as_timestamp("day")),
                   CAMPAIGN_DATA_WB_PERIOD)


# ------------------------------------------------------------------------------------- JOB-3 / JOB-4
def flatten_history(history: DataFrame, keep: Sequence[str] = TENANT) -> DataFrame:
    """PRJ-4: ``data[]{nmID, imtName, vendorCode, history[]{dt, ...}}`` -> 13 columns per product-day.
    Failed payloads (``error`` true or no ``data``) are skipped (FLT-10)."""
    keep = [c for c in keep if c in history.columns]
    ok = history
    if "error" in history.columns:
        ok = ok.filter(~F.coalesce(F.col("error"), F.lit(False)))
    products = explode_with_meta(ok, "data", keep=keep)
    rows = explode_with_meta(products, "history", meta=["nmID", "imtName", "vendorCode"], keep=keep)
    return typed(rows, [("nmID", "bigint"), *flat_types(PRODUCT_HISTORY_DAY)])


def product_day_orders_from_history(history_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename to the fact's key names (JON-4 by renaming: nmID->nmId, dt->day as a date)."""
    return history_rows.select(*keep, F.col("nmID").alias("nmId"), F.to_date(to_wall_clock("dt")).alias("day"),
                               *ORDER_METRICS)


# The numeric columns of a flat card.
FUNNEL_TYPES = [("nmID", "bigint"), ("objectID", "int"), ("stocksMp", "int"), ("stocksWb", "int"),
                *[(c, "int") for c in ("openCardCount", "addToCartCount", "ordersCount", "buyoutsCount", "cancelCount")],
                *[(c, "double") for c in ("ordersSumRub", "buyoutsSumRub", "cancelSumRub", "avgOrdersCountPerDay", "avgPriceRub",
                                          "addToCartPercent", "cartToOrderPercent", "buyoutsPercent")]]


def flatten_funnel_cards(pages: DataFrame, keep: Sequence[str] = TENANT) -> DataFrame:
    """PRJ-5: funnel cards (pages concatenated) -> 22 flat columns from struct paths."""
    keep = [c for c in keep if c in pages.columns]
    cards = explode_with_meta(pages, "data.cards", keep=keep)
    sp = "statistics.selectedPeriod"
    paths = {c: c for c in keep}
    paths.update({
        "nmID": "nmID", "vendorCode": "vendorCode", "brandName": "brandName",
        "objectID": "object.id", "objectName": "object.name",
        "begin": f"{sp}.begin", "end": f"{sp}.end",
        "openCardCount": f"{sp}.openCardCount", "addToCartCount": f"{sp}.addToCartCount",
        "ordersCount": f"{sp}.ordersCount", "ordersSumRub": f"{sp}.ordersSumRub",
        "buyoutsCount": f"{sp}.buyoutsCount", "buyoutsSumRub": f"{sp}.buyoutsSumRub",
        "cancelCount": f"{sp}.cancelCount", "cancelSumRub": f"{sp}.cancelSumRub",
        "avgOrdersCountPerDay": f"{sp}.avgOrdersCountPerDay", "avgPriceRub": f"{sp}.avgPriceRub",
        "addToCartPercent": f"{sp}.conversions.addToCartPercent",
        "cartToOrderPercent": f"{sp}.conversions.cartToOrderPercent",
        "buyoutsPercent": f"{sp}.conversions.buyoutsPercent",
        "stocksMp": "stocks.stocksMp", "stocksWb": "stocks.stocksWb",
    })
    return typed(select_paths(cards, paths), FUNNEL_TYPES)


def product_day_orders_from_cards(card_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JOB-4: a card's ``begin`` is the day of its numbers."""
    return card_rows.select(*keep, F.col("nmID").alias("nmId"), F.to_date(to_wall_clock("begin")).alias("day"),
                            *ORDER_METRICS)


def ad_orders_fact(facts_with_campaign: DataFrame, product_day_orders: DataFrame,
                   by_project: bool = False, coverage: DataFrame | None = None) -> DataFrame:
    """JOB-3/JOB-4 (JON-2 + SCA-13): attach product-day orders to every ad row of that product and day,
    0 where there are none, in the 22-column contract.

    The key is (nmId, day), as in the source; ``by_project=True`` adds Project to it. A product-day's orders
    repeat on each of its campaign rows, so totals after the join can exceed those before (see
    ``operators.quality.reconcile_totals``).

    With ``coverage`` (Project, first_day, last_day: the days whose orders were landed, see ``operators.coverage``) a missing row means 0
    only on covered days; on the others the orders are unknown and stay null.
    """
    key = ["nmId", "day", *(["Project"] if by_project else [])]
    orders = product_day_orders.select(*key, *ORDER_METRICS)
    joined = left_join(facts_with_campaign, orders, key)
    if coverage is None:
        joined = fill_zero(joined, ORDER_METRICS)
    else:
        joined = with_coverage(joined, coverage).withColumns(
            {c: F.when(F.col("covered") & F.col(c).isNull(), F.lit(0)).otherwise(F.col(c)) for c in ORDER_METRICS})
    types = dict(CAMPAIGN_DATA_WB)
    joined = joined.withColumns({c: F.col(c).cast(types[c]) for c in ORDER_METRICS})
    return conform(joined.withColumn("day", day_as_timestamp("day")), CAMPAIGN_DATA_WB)


def ad_orders_fact_orders_first(facts: DataFrame, dim: DataFrame, product_day_orders: DataFrame) -> DataFrame:
    """JON-5: the two joins of ``ad_orders_fact`` the other way round: orders on the plain facts first, campaigns after; the same rows."""
    orders = product_day_orders.select("nmId", "day", *ORDER_METRICS)
    joined = fill_zero(left_join(facts, orders, ["nmId", "day"]), ORDER_METRICS)
    return conform(ad_facts_with_campaign(joined, dim).withColumn("day", day_as_timestamp("day")), CAMPAIGN_DATA_WB)


# ------------------------------------------------------------------------------------------- JOB-5
def product_first_fact(product_day_orders: DataFrame, facts_with_campaign: DataFrame,
                       null_safe: bool = False) -> DataFrame:
    """JOB-5 (JON-3): every product-day with orders, with its ad rows where they exist (ad columns null
    otherwise). Both sides are aggregates: the ad side has at most a row for each campaign of a product-day, so no key is
    hot. ``null_safe`` joins null keys to null keys (pandas parity)."""
    ads = facts_with_campaign.drop(*[c for c in ORDER_METRICS if c in facts_with_campaign.columns])
    return left_join(product_day_orders, ads, ["nmId", "day"], null_safe=null_safe)


# ------------------------------------------------------------------------------------------- JOB-7
def reload_ad_window(spark: SparkSession, flat_stats: DataFrame, dim: DataFrame, product_day_orders: DataFrame,
                     target: writers.Target, today: dt.date | str, days: int = 6) -> tuple[dt.date, dt.date]:
    """JOB-7: recompute the ad fact with orders for ``days`` days ending yesterday and replace exactly those
    days in ``target`` (SNK-2; a 22-column table partitioned by ``day`` as a date). Stats and orders are
    filtered to the window first, so day-partitioned landed data is pruned at the scan. Returns the window."""
    first, last = reload_days(today, days)
    lo, hi = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    flat = flat_stats.filter(F.to_date("date").between(lo, hi))
    orders = product_day_orders.filter(F.col("day").between(lo, hi))
    facts = ad_facts_with_campaign(ad_daily_fact(flat), dim)
    out = ad_orders_fact(facts, orders).withColumn("day", F.to_date("day"))
    writers.reload_window(spark, out, target, first, last, part_col="day")
    return first, last

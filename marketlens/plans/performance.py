"""Performance-advertising jobs (JOB-15 to JOB-17): campaign dimension, campaign objects, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.clean import label_or_null, map_and_join, to_wall_clock, tolerant_doubles
from ..operators.aggregate import exact_sum
from ..operators.flatten import explode_with_meta
from ..schemas import PRODUCT_STATS_METRICS


def performance_campaign_dim(campaigns: DataFrame, created_from: str | None = None,
                             maps: Mapping[str, Mapping] | None = None,
                             placement_labels: Mapping = labels.PLACEMENT) -> DataFrame:
    """JOB-15: ``list[]`` of campaigns -> one row each; five code columns become labels with unknown codes
    null (SCA-2); the placement array is mapped element-wise with unknowns kept and joined with ', '
    (SCA-17); optionally only campaigns created on or after ``created_from`` (FLT-5, ISO text compare)."""
    maps = maps if maps is not None else {
        "productCampaignMode": labels.CAMPAIGN_MODE,
        "productAutopilotStrategy": labels.AUTOPILOT_STRATEGY,
        "advObjectType": labels.ADV_OBJECT_TYPE,
        "state": labels.CAMPAIGN_STATE,
        "PaymentType": labels.PAYMENT_TYPE,
    }
    rows = explode_with_meta(campaigns, "list") if "list" in campaigns.columns else campaigns
    rows = rows.withColumns({c: label_or_null(c, m) for c, m in maps.items() if c in rows.columns})
    if "placement" in rows.columns:
        rows = rows.withColumn("placement", map_and_join("placement", placement_labels))
    if created_from is not None:
        rows = rows.filter(F.col("createdAt") >= F.lit(created_from))
    return rows


def campaign_objects(objects: DataFrame, campaign_col: str = "campaign_id") -> DataFrame:
    """JOB-16 (PRJ-11): per-campaign object lists -> (campaign_id, object_id)."""
    return (explode_with_meta(objects, "list", keep=[campaign_col])
            .select(campaign_col, F.col("id").alias("object_id")))


def typed_report(report: DataFrame, metrics: Sequence[str] = PRODUCT_STATS_METRICS) -> DataFrame:
    """JOB-17, row level: the text metrics that are present are cast tolerantly to numbers (SCA-3; bad text
    becomes null), other columns are kept as they are."""
    return tolerant_doubles(report, metrics)


# The metrics that add up over rows, and the ratios with their parts (percent, or per 1000 for the last one).
ADDITIVE = ["spending", "views", "clicks", "addToCart", "ordersCount", "ordersSum"]
BUDGETS = ["dailyBudget", "weeklyBudget"]
RATIOS = {"ctr": ("clicks", "views", 100.0), "averageClickPrice": ("spending", "clicks", 1.0), "drr": ("spending", "ordersSum", 100.0),
          "average1000ViewsPrice": ("spending", "views", 1000.0)}


def performance_stats(report: DataFrame, campaign_col: str = "campaignId", date_col: str = "date", digits: int = 6) -> DataFrame:
    """JOB-17 grouped: the typed report (SCA-3; absent metrics are skipped) grouped by campaign and day (AGG-10, the grouping the source
    asks its API for), with a row count.

    Only metrics that add up are summed (as exact decimals, cut to doubles at the end). Ratios come from the sums (null over 0). A budget is
    a property of the campaign: its largest value of the day; ``averageRate`` is the mean of the rows that have one.
    """
    metrics = [m for m in PRODUCT_STATS_METRICS if m in report.columns]
    typed = typed_report(report, metrics).select(F.col(campaign_col), F.to_date(to_wall_clock(date_col)).alias("day"), *metrics)
    aggs = [exact_sum(m).alias(m) for m in ADDITIVE if m in metrics] + [F.max(m).alias(m) for m in BUDGETS if m in metrics]
    if "averageRate" in metrics:
        aggs.append(F.round(exact_sum("averageRate") / F.count("averageRate"), digits).alias("averageRate"))
    out = typed.groupBy(campaign_col, "day").agg(*aggs, F.count(F.lit(1)).alias("n_rows"))
    for name, (part, whole, scale) in RATIOS.items():
        if {name, part, whole} <= set(metrics):
            out = out.withColumn(name, F.round(F.try_divide(F.col(part) * scale, F.nullif(whole, F.lit(0.0))), digits))
    return out.select(campaign_col, "day", *[m for m in metrics if m in out.columns], "n_rows")

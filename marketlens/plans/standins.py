"""Stand-in inputs: rows in the landed schemas, built from the supplied tables.

These adapters only rename and re-shape columns into the schema a job expects (role map: product =
``user_id``, campaign = ``event_type``, day = ``to_date(ts)``, views = ``props.k``, spend = ``value``). They
do none of the job's work: no grouping the job does, no filtering, no result. Nested payloads are built one
record per source row (arrays from that row's own columns), or, where a parent really owns several children,
as pages of bounded size (``nest_pages``), the way the source API pages its responses; no parent is ever
collected whole into one record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import to_long_or_zero
from ..functions.labels import MARKETPLACE_WB
from ..session import scratch_path, spread_small
from ..sources.landed import read_landed


def json_metric(text_col: str, key: str) -> Column:
    """SCA-3/4 on a JSON text metric: ``$.key`` as text, tolerant cast, 0 when missing, int64."""
    return to_long_or_zero(F.get_json_object(F.col(text_col), f"$.{key}"))


def ad_stats_rows(events: DataFrame, project: str = "events") -> DataFrame:
    """Flat ad-statistics rows (the 14 columns of PRJ-3's output) from ``events``."""
    purchase = F.col("event_type") == "purchase"
    k = json_metric("props", "k")
    return events.select(
        F.col("ts").alias("date"),
        F.col("user_id").alias("nmId"),
        F.concat_ws("#", "event_type", F.col("event_id").cast("string")).alias("name"),
        k.alias("views"),
        F.lit(1).cast("bigint").alias("clicks"),
        (k / F.lit(100.0)).alias("ctr"),
        F.col("value").alias("cpc"),
        F.col("value").alias("sum"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("bigint").alias("atbs"),
        F.when(purchase, 1).otherwise(0).cast("bigint").alias("orders"),
        F.when(purchase, 100.0).otherwise(0.0).alias("cr"),
        F.when(purchase, 1).otherwise(0).cast("bigint").alias("shks"),
        F.when(purchase, F.col("value")).otherwise(0.0).alias("sum_price"),
        F.col("event_type").alias("advertId"),
        F.lit(project).alias("Project"),
        F.lit(MARKETPLACE_WB).alias("Marketplace"),
    )


# SQL twin of ad_stats_rows for the DuckDB oracle (same role map, same literals).
AD_STATS_ROWS_SQL = """
SELECT ts AS date, user_id AS nmId, event_type || '#' || CAST(event_id AS VARCHAR) AS name,
       COALESCE(CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT), 0) AS views,
       CAST(1 AS BIGINT) AS clicks,
       COALESCE(CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT), 0) / CAST(100 AS DOUBLE) AS ctr,
       value AS cpc, value AS sum,
       CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS atbs,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS orders,
       CAST(CASE WHEN event_type = 'purchase' THEN 100 ELSE 0 END AS DOUBLE) AS cr,
       CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS shks,
       CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS sum_price,
       event_type AS advertId, 'events' AS Project, 'Wildberries' AS Marketplace
FROM events
"""


def product_day_history_rows(events: DataFrame) -> DataFrame:
    """Product-day history rows (the columns of PRJ-4's output that the attribution uses), as the source
    reports them: one row per product and day with purchases. ``ordersCount`` is the number of purchases,
    ``ordersSumRub`` their value, ``addToCartCount`` the sum of their ``props.k``."""
    purchases = events.filter(F.col("event_type") == "purchase")
    return (purchases.groupBy(F.col("user_id").alias("nmID"), F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("ordersCount"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("ordersSumRub"),
                 F.sum(json_metric("props", "k")).alias("addToCartCount"))
            .select("nmID", F.date_format("day", "yyyy-MM-dd").alias("dt"), "ordersCount", "ordersSumRub",
                    "addToCartCount"))


PRODUCT_DAY_HISTORY_SQL = """
SELECT user_id AS nmId, CAST(ts AS DATE) AS day, COUNT(*) AS ordersCount,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS ordersSumRub,
       CAST(SUM(COALESCE(CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT), 0))
            AS BIGINT) AS addToCartCount
FROM events WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE)
"""


def land(df: DataFrame, stem: str, page: Column) -> str:
    """Write a page of JSON text for each row, one a line, under ``project=/day=`` folders of the shared folder; returns the root. Rows are
    dealt by folder, and a folder above the advisory partition size is written by several tasks."""
    path = scratch_path(df.sparkSession, f"landed-{stem}")
    pages = df.select("project", "day", page.alias("value")).hint("rebalance", F.col("project"), F.col("day"))
    with spread_small(pages):
        pages.write.partitionBy("project", "day").text(path)
    return path


def land_text(spark: SparkSession, path: str, project: str, day: str, text: str) -> None:
    """One more page, as it came."""
    spark.createDataFrame([(text,)], "value string").write.mode("append").text(f"{path}/project={project}/day={day}")


def landed(df: DataFrame, stem: str, page: Column, schema: str) -> DataFrame:
    """Pages written as files of one project and day, one page a line and as many files as ``df`` has parts, and read back typed."""
    path = scratch_path(df.sparkSession, f"landed-{stem}")
    df.select(page.alias("value")).write.text(f"{path}/project=p/day=2024-02-01")
    return read_landed(df.sparkSession, path, schema, multi_line=False).drop("project", "day")


def nest_pages(children: DataFrame, parent: Sequence[str], item: Column, order: Sequence[str],
               page_size: int = 256) -> DataFrame:
    """Nest child rows under their parent as pages of about ``page_size`` items: one record per
    (parent, page) with ``items`` sorted by ``order``.

    The page count of a parent comes from a partial-aggregated count, and each child goes to a page by a
    hash of its columns, so a parent holding a third of all rows is split over many records instead of
    being collected whole into one group. A parent with at most ``page_size`` children is one record.
    """
    parent = list(parent)
    counts = children.groupBy(*parent).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select(*[F.col(c).alias(f"__p_{c}") for c in parent], "__n")
    pages = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(page_size)))
    h = F.xxhash64(*[F.col(c) for c in children.columns])
    same_parent = None
    for c in parent:  # null-safe: children of a null parent are nested too, not dropped
        term = F.col(c).eqNullSafe(F.col(f"__p_{c}"))
        same_parent = term if same_parent is None else same_parent & term
    paged = (children.join(counts, same_parent).drop(*[f"__p_{c}" for c in parent])
             .withColumn("__page", F.when(pages > 1, F.pmod(h, pages)).otherwise(F.lit(0))))
    # collect_list gains nothing from a map-side partial step (it keeps every row), so shuffle the rows by
    # (parent, page) first: the collect then runs after the only shuffle, in parallel, and a hot parent's
    # pages land in different tasks.
    return (paged.repartition(*[F.col(c) for c in parent], F.col("__page")).groupBy(*parent, "__page")
            .agg(F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], item.alias("__item"))))
                 .alias("__items"))
            .select(*parent, F.transform("__items", lambda s: s["__item"]).alias("items")))

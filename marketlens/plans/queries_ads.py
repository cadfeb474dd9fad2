"""Registered advertising and performance queries (FIXTURES B1-B8, B19, B36, and JOB-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.clean import label_map, label_or_null
from ..operators.joins import restrict_to_keys
from ..operators.quality import reconcile_totals
from ..schemas import PERFORMANCE_CAMPAIGNS
from ..session import shared_dir
from ..sources.tables import table
from . import ads, performance, standins
from .catalog import register
from .sqlgen import case_map, lit, values

# ---------------------------------------------------------------------------------------------- B1
AD_DAILY_FACT_SQL = f"""
SELECT Project, Marketplace, CAST(date AS DATE) AS day, nmId, advertId,
       MIN(date) AS date, arg_min(name, date) AS name,
       CAST(COALESCE(SUM(views), 0) AS BIGINT) AS views, CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks,
       COALESCE(CAST(SUM(CAST(sum AS DECIMAL(18,2))) AS DOUBLE), 0) AS sum,
       CAST(COALESCE(SUM(atbs), 0) AS BIGINT) AS atbs, CAST(COALESCE(SUM(orders), 0) AS BIGINT) AS orders,
       CAST(COALESCE(SUM(shks), 0) AS BIGINT) AS shks,
       COALESCE(CAST(SUM(CAST(sum_price AS DECIMAL(18,2))) AS DOUBLE), 0) AS sum_price,
       ROUND(AVG(ctr), 6) AS ctr, ROUND(AVG(cpc), 6) AS cpc, ROUND(AVG(cr), 6) AS cr
FROM ({standins.AD_STATS_ROWS_SQL}) s
GROUP BY Project, Marketplace, CAST(date AS DATE), nmId, advertId
"""


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_daily_fact(standins.ad_stats_rows(table(spark, sf_dir, "events")), order_cols=("date",))


@register("ad_daily_fact", AD_DAILY_FACT_SQL)
def q_ad_daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 (JOB-1, AGG-1, SCA-8): daily ad fact per tenant, day, product and campaign."""
    return daily_fact(spark, sf_dir)


# ---------------------------------------------------------------------------------------------- B2
CAMPAIGN_DIM_SQL = f"""
SELECT CAST(NULL AS DATE) AS endTime, CAST(NULL AS DATE) AS createTime, CAST(NULL AS DATE) AS startTime,
       s_name AS name, s_suppkey AS advertId,
       {case_map('s_nationkey', labels.CAMPAIGN_STATUS, True)} AS status,
       {case_map('n_regionkey', labels.CAMPAIGN_TYPE, True)} AS type
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""


@register("campaign_dim", CAMPAIGN_DIM_SQL)
def q_campaign_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 (JOB-2: SCA-1, SCA-6/8, PRJ-12/14): campaign details -> dimension with labelled status and type,
    unknown codes kept as text. Stand-in details: advertId = supplier key, name = supplier name,
    status code = nation key, type code = region key; no times are known (null)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    details = (table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
               .select(F.col("s_suppkey").alias("advertId"), F.col("s_name").alias("name"),
                       F.col("s_nationkey").alias("status"), F.col("n_regionkey").alias("type"),
                       *[F.lit(None).cast("string").alias(c) for c in ("createTime", "startTime", "endTime")]))
    return ads.campaign_dim(details)


# ---------------------------------------------------------------------------------------------- B3
# Parameter of this query: the order-status map, with code 'P' deliberately left out.
ORDER_STATUS_LABELS = {"F": "finished", "O": "open"}

LABEL_OR_NULL_SQL = f"""
SELECT o_orderkey, o_orderstatus, {case_map('o_orderstatus', ORDER_STATUS_LABELS, False)} AS status_label
FROM orders
"""


@register("label_or_null", LABEL_OR_NULL_SQL)
def q_label_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 (SCA-2): code to label, a code missing from the map becomes null."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    label_or_null("o_orderstatus", ORDER_STATUS_LABELS).alias("status_label"))


# ---------------------------------------------------------------------------------------------- B4
# Parameter of this query: a literal campaign-details table keyed by event type ('error' left out, and
# status 5 is not a known code, so it is kept as text).
CAMPAIGN_ROWS = [
    ("click", "Search campaign", 9, 6, "2023-12-01T10:15:00+03:00", "2023-12-02T00:00:00", "2024-02-29"),
    ("view", "Catalog campaign", 11, 4, "2023-11-20 08:00:00", "2023-11-21T09:30:00.123+03:00", "2024-01-31"),
    ("purchase", "Auto campaign", 7, 8, "2023-10-05", "2023-10-06", "2024-01-15T23:59:59"),
    ("signup", "Auction campaign", 5, 9, "2023-12-31T23:30:00+03:00", "2024-01-01", "2024-03-01"),
]
CAMPAIGN_DETAIL_COLUMNS = ["advertId", "name", "status", "type", "createTime", "startTime", "endTime"]


def campaign_details(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAMPAIGN_ROWS, "advertId string, name string, status int, type int,"
                                                " createTime string, startTime string, endTime string")


def _campaign_dim_sql() -> str:
    rows = [(a, n, labels.CAMPAIGN_STATUS.get(s, str(s)), labels.CAMPAIGN_TYPE.get(t, str(t)),
             c[:10], st[:10], e[:10]) for a, n, s, t, c, st, e in CAMPAIGN_ROWS]
    return values(rows, ["advertId", "name_campaign", "status", "type", "createTime", "startTime", "endTime"],
                  ["VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR", "DATE", "DATE", "DATE"])


FACTS_WITH_CAMPAIGN_SQL = f"""
SELECT f.Project, f.Marketplace, f.day, f.nmId, f.advertId, f.date, f.name AS name_product, f.views, f.clicks,
       f.sum, f.atbs, f.orders, f.shks, f.sum_price, d.endTime, d.createTime, d.startTime, d.name_campaign,
       d.status, d.type
FROM ({AD_DAILY_FACT_SQL}) f LEFT JOIN {_campaign_dim_sql()} d ON f.advertId = d.advertId
"""

AD_PERIOD_FACT_SQL = f"""
SELECT nmId, CAST(day AS TIMESTAMP) AS day, name_product, views, clicks, sum, atbs, orders, shks, sum_price,
       advertId, Project, Marketplace, endTime, createTime, startTime, name_campaign, status, type
FROM ({FACTS_WITH_CAMPAIGN_SQL}) x
"""


def facts_with_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_facts_with_campaign(daily_fact(spark, sf_dir), ads.campaign_dim(campaign_details(spark)))


@register("ad_facts_with_campaign", AD_PERIOD_FACT_SQL)
def q_ad_facts_with_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 (JOB-6: JON-1, PRJ-13/14, SCA-9): daily facts LEFT JOIN the campaign dimension in the 19-column
    period contract. The dimension is a fixed 4-row parameter; one campaign of the facts has no row."""
    return ads.ad_period_fact(daily_fact(spark, sf_dir), ads.campaign_dim(campaign_details(spark)))


# ---------------------------------------------------------------------------------------------- B5
AD_ORDERS_FACT_SQL = f"""
SELECT x.nmId, CAST(x.day AS TIMESTAMP) AS day, x.name_product, x.views, x.clicks, x.sum, x.atbs, x.orders,
       x.shks, x.sum_price, x.advertId, x.Project, x.Marketplace, x.endTime, x.createTime, x.startTime,
       x.name_campaign, x.status, x.type,
       COALESCE(o.ordersCount, 0) AS ordersCount, COALESCE(o.ordersSumRub, 0) AS ordersSumRub,
       COALESCE(o.addToCartCount, 0) AS addToCartCount
FROM ({FACTS_WITH_CAMPAIGN_SQL}) x
LEFT JOIN ({standins.PRODUCT_DAY_HISTORY_SQL}) o ON x.nmId = o.nmId AND x.day = o.day
"""


def product_day_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.product_day_orders_from_history(standins.product_day_history_rows(table(spark, sf_dir, "events")))


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_orders_fact(facts_with_campaign(spark, sf_dir), product_day_orders(spark, sf_dir))


@register("ad_orders_fact", AD_ORDERS_FACT_SQL)
def q_ad_orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 (JOB-3: JON-2, SCA-13): ad facts with the product-day orders of their product and day, 0 where
    none, in the 22-column contract."""
    return orders_fact(spark, sf_dir)


# ---------------------------------------------------------------------------------------------- B6
PRODUCT_FIRST_SQL = f"""
SELECT o.nmId, o.day, o.ordersCount, o.ordersSumRub, o.addToCartCount, x.Project, x.Marketplace, x.advertId,
       x.date, x.name_product, x.views, x.clicks, x.sum, x.atbs, x.orders, x.shks, x.sum_price, x.endTime,
       x.createTime, x.startTime, x.name_campaign, x.status, x.type
FROM ({standins.PRODUCT_DAY_HISTORY_SQL}) o
LEFT JOIN ({FACTS_WITH_CAMPAIGN_SQL}) x ON o.nmId = x.nmId AND o.day = x.day
"""


@register("product_first_fact", PRODUCT_FIRST_SQL)
def q_product_first_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 (JOB-5: JON-3): product-day orders LEFT JOIN ad facts; ad columns null where no ad ran."""
    return ads.product_first_fact(product_day_orders(spark, sf_dir), facts_with_campaign(spark, sf_dir))


# ---------------------------------------------------------------------------------------------- B7
BRAND = "Brand#13"
RESTRICT_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = {lit(BRAND)})
"""


@register("restrict_to_keys", RESTRICT_SQL)
def q_restrict_to_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 (JON-6): keep the lines whose part belongs to one brand (the "project"): a left semi join on the
    brand's part keys."""
    keys = (table(spark, sf_dir, "part").filter(F.col("p_brand") == BRAND)
            .select(F.col("p_partkey").alias("l_partkey")))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                    "l_quantity", "l_extendedprice")
    return restrict_to_keys(lines, keys, ["l_partkey"])


# ---------------------------------------------------------------------------------------------- B8
_TOTALS = ("SELECT CAST(SUM(ordersCount) AS BIGINT) AS c, SUM(CAST(ordersSumRub AS DECIMAL(18,2))) AS s,"
           " CAST(SUM(addToCartCount) AS BIGINT) AS t FROM")
RECONCILE_SQL = f"""
WITH b AS ({_TOTALS} ({standins.PRODUCT_DAY_HISTORY_SQL}) o), a AS ({_TOTALS} ({AD_ORDERS_FACT_SQL}) f)
SELECT b.c AS ordersCount_before, a.c AS ordersCount_after, a.c - b.c AS ordersCount_diff,
       CAST(b.s AS DOUBLE) AS ordersSumRub_before, CAST(a.s AS DOUBLE) AS ordersSumRub_after,
       CAST(a.s - b.s AS DOUBLE) AS ordersSumRub_diff,
       b.t AS addToCartCount_before, a.t AS addToCartCount_after, a.t - b.t AS addToCartCount_diff
FROM a, b
"""


@register("reconcile_orders", RECONCILE_SQL)
def q_reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 (AGG-7): order totals before and after the attribution join, and their difference (the join
    repeats a product-day's orders on each of its campaign rows). Both sides read one frame of product-day orders, which is
    checkpointed, so the events are scanned once for it and once for the facts."""
    shared_dir(spark)
    orders = product_day_orders(spark, sf_dir).checkpoint(eager=True)
    return reconcile_totals(orders, ads.ad_orders_fact(facts_with_campaign(spark, sf_dir), orders),
                            {"ordersCount": None, "ordersSumRub": 2, "addToCartCount": None})


# --------------------------------------------------------------------------------------------- B19
EVENT_TYPE_LABELS = {"click": "Клик", "purchase": "Покупка", "view": "Просмотр"}

ARRAY_LABELS_SQL = f"""
SELECT user_id, day, string_agg({case_map('event_type', EVENT_TYPE_LABELS, True)}, ', ' ORDER BY event_type)
       AS placement
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events) t
GROUP BY user_id, day
"""


@register("array_labels", ARRAY_LABELS_SQL)
def q_array_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19 (JOB-15 placement rule, SCA-17): the sorted set of event types of a user and day is an array
    column (like ``placement``); each element is mapped to its label, unknown elements kept, joined
    with ', '. ``collect_set`` is bounded by the number of distinct types, not by rows."""
    ev = table(spark, sf_dir, "events")
    arrays = (ev.groupBy("user_id", F.to_date("ts").alias("day"))
              .agg(F.array_sort(F.collect_set("event_type")).alias("placement")))
    out = performance.performance_campaign_dim(arrays, maps={}, placement_labels=EVENT_TYPE_LABELS)
    return out.select("user_id", "day", "placement")


# --------------------------------------------------------------------------------------------- B36
REPORT_BY_DATE_SQL = """
WITH r AS (
  SELECT event_type AS campaignId, CAST(ts AS DATE) AS day, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS views,
         CAST(1 AS DOUBLE) AS clicks, value AS spending, user_id % 3 AS addToCart, user_id % 2 AS ordersCount, value * 2 AS ordersSum,
         CAST(100 + user_id % 7 AS DOUBLE) AS dailyBudget, CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(user_id % 5 AS DOUBLE) END AS averageRate
  FROM events
), s AS (
  SELECT campaignId, day, MAX(dailyBudget) AS dailyBudget, MAX(dailyBudget) * 7 AS weeklyBudget,
         CAST(SUM(CAST(spending AS DECIMAL(38,10))) AS DOUBLE) AS spending, CAST(SUM(CAST(views AS DECIMAL(38,10))) AS DOUBLE) AS views,
         CAST(SUM(CAST(clicks AS DECIMAL(38,10))) AS DOUBLE) AS clicks, CAST(SUM(CAST(addToCart AS DECIMAL(38,10))) AS DOUBLE) AS addToCart,
         ROUND(CAST(SUM(CAST(averageRate AS DECIMAL(38,10))) AS DOUBLE) / COUNT(averageRate), 6) AS averageRate,
         CAST(SUM(CAST(ordersCount AS DECIMAL(38,10))) AS DOUBLE) AS ordersCount, CAST(SUM(CAST(ordersSum AS DECIMAL(38,10))) AS DOUBLE) AS ordersSum,
         COUNT(*) AS n_rows
  FROM r GROUP BY campaignId, day
)
SELECT campaignId, day, dailyBudget, weeklyBudget, spending, views, clicks, addToCart, averageRate,
       ROUND(spending * 1000.0::DOUBLE / NULLIF(views, 0), 6) AS average1000ViewsPrice, ROUND(clicks * 100.0::DOUBLE / NULLIF(views, 0), 6) AS ctr,
       ROUND(spending * 1.0::DOUBLE / NULLIF(clicks, 0), 6) AS averageClickPrice, ordersCount, ordersSum,
       ROUND(spending * 100.0::DOUBLE / NULLIF(ordersSum, 0), 6) AS drr, n_rows
FROM s
"""


@register("report_by_date", REPORT_BY_DATE_SQL)
def q_report_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B36 (JOB-17: SCA-3, AGG-10): a text-valued statistics report with all 13 metrics, cast tolerantly and grouped by
    campaign and day: additive metrics summed, ratios from the sums, budgets by their largest value. Stand-in report rows:
    campaign = event type, metrics as the source sends them (text; the row's own ratios are noise, as they must not be used)."""
    ev = table(spark, sf_dir, "events")
    user, text = F.col("user_id"), lambda c: c.cast("string")
    report = ev.select(F.col("event_type").alias("campaignId"), text(F.col("ts")).alias("date"),
                       F.get_json_object("props", "$.k").alias("views"), F.lit("1").alias("clicks"), text(F.col("value")).alias("spending"),
                       text(user % 3).alias("addToCart"), text(user % 2).alias("ordersCount"), text(F.col("value") * 2).alias("ordersSum"),
                       text(100 + user % 7).alias("dailyBudget"), text((100 + user % 7) * 7).alias("weeklyBudget"),
                       F.when(user % 5 == 0, F.lit("n/a")).otherwise(text(user % 5)).alias("averageRate"),
                       *[F.lit("12.5").alias(m) for m in ("ctr", "drr", "averageClickPrice", "average1000ViewsPrice")])
    return performance.performance_stats(report)


# ------------------------------------------------------------------------------------------- JOB-15
# Parameters of this query: codes the stand-in campaigns carry, taken from an order's status and priority.
# 'CAMPAIGN_STATE_NEW' and the two lowest priorities are not in the source's label maps (they become null).
STATE_CODE_OF_STATUS = {"F": "CAMPAIGN_STATE_FINISHED", "O": "CAMPAIGN_STATE_RUNNING", "P": "CAMPAIGN_STATE_NEW"}
PAYMENT_CODE_OF_PRIORITY = {"1-URGENT": "CPC", "2-HIGH": "CPM", "3-MEDIUM": "CPA"}
PLACEMENT_CODE_OF_PRIORITY = {"1-URGENT": "PLACEMENT_TOP_PROMOTION", "2-HIGH": "PLACEMENT_SEARCH_AND_CATEGORY"}
CREATED_FROM = "1998-01-01"


def _code(col: str, mapping: dict):
    return label_map(mapping)[F.col(col)]


PERFORMANCE_DIM_SQL = f"""
WITH c AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title,
         {case_map('o_orderstatus', STATE_CODE_OF_STATUS, False)} AS state_code,
         {case_map('o_orderpriority', PAYMENT_CODE_OF_PRIORITY, False)} AS payment_code,
         COALESCE({case_map('o_orderpriority', PLACEMENT_CODE_OF_PRIORITY, False)}, o_orderpriority) AS placement_code,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS createdAt
  FROM orders)
SELECT id, title, {case_map('state_code', labels.CAMPAIGN_STATE, False)} AS state,
       CAST(NULL AS VARCHAR) AS advObjectType,
       {case_map('payment_code', labels.PAYMENT_TYPE, False)} AS PaymentType,
       CAST(NULL AS VARCHAR) AS productCampaignMode, CAST(NULL AS VARCHAR) AS productAutopilotStrategy,
       COALESCE({case_map('placement_code', labels.PLACEMENT, False)}, placement_code) || ', '
         || {lit(labels.PLACEMENT['PLACEMENT_PDP'])} AS placement,
       createdAt
FROM c WHERE createdAt >= {lit(CREATED_FROM)}
"""


@register("performance_campaign_dim", PERFORMANCE_DIM_SQL)
def q_performance_campaign_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11, JOB-15 (SCA-2, SCA-17, FLT-5): campaign lists read from landed files; five code columns mapped with the
    source's labels (unknown codes null), the placement array mapped element-wise (unknown kept) and joined,
    then only campaigns created on or after a day (ISO text compare). Stand-in: one campaign per order, its
    codes taken from the order's status and priority through the fixed code tables above."""
    o = table(spark, sf_dir, "orders")
    camp = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("title"),
        _code("o_orderstatus", STATE_CODE_OF_STATUS).alias("state"),
        _code("o_orderpriority", PAYMENT_CODE_OF_PRIORITY).alias("PaymentType"),
        F.array(F.coalesce(_code("o_orderpriority", PLACEMENT_CODE_OF_PRIORITY), F.col("o_orderpriority")),
                F.lit("PLACEMENT_PDP")).alias("placement"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"))
    lists = standins.landed(o, "campaigns", F.to_json(F.struct(F.array(camp).alias("list"))), PERFORMANCE_CAMPAIGNS)
    out = performance.performance_campaign_dim(lists, created_from=CREATED_FROM)
    return out.select("id", "title", "state", "advObjectType", "PaymentType", "productCampaignMode",
                      "productAutopilotStrategy", "placement", "createdAt")

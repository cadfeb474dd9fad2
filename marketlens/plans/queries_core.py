"""Registered queries for flattening, cleaning, dates, windows, aggregates, sets and finance
(FIXTURES B9-B31, B35, B37, B38, plus campaign objects and ERP profit)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import date_or_sentinel, fill_zero, text_after_last, to_double, to_long_or_zero, to_wall_clock
from ..functions.dates import (calendar, date_parts, day_end_text, day_start_text, iso_utc_text, previous_week_end,
                               previous_week_start, unpadded_date_text, year_start)
from ..functions.labels import MARKETPLACE_WB, REALIZATION_SOURCE
from ..operators.aggregate import distinct_count, filtered_total, regroup_sum, total
from ..operators.filters import equals
from ..operators.joins import left_join
from ..operators.project import conform
from ..operators.quality import rows_per_project
from ..operators.setops import union_projects
from ..operators.sort import sort_desc, top_k
from ..operators.window import latest_version
from ..schemas import (AD_STATS, CAMPAIGN_OBJECTS, ERP_PROFIT, ERP_STOCK, FINANCE_OPERATIONS, FUNNEL_PAGE,
                       PRODUCT_HISTORY, REALIZATION_BY_DAY, WAREHOUSE_REMAINS, WB_FINANCE)
from ..sources.landed import parse_json_text
from ..sources.tables import table
from . import ads, erp, finance, funnel, performance, standins, stock
from .catalog import register
from .sqlgen import lit

# A fixed "now" for every query that stamps a load time (reruns must hash identically).
NOW = "2024-02-01 06:00:00"


def _json_payload(df: DataFrame, payload, schema: str, keep=()) -> DataFrame:
    """Serialise a built struct to JSON text and read it back with the landed schema (the typed reader).
    Both steps are CPU-heavy and narrow."""
    return parse_json_text(df.select(*keep, F.to_json(payload).alias("payload")), "payload", schema, keep)


# ---------------------------------------------------------------------------------------------- B9
ORDERS_LINES_LEFT_SQL = """
SELECT o_orderkey, o_orderdate, COALESCE(n_lines, 0) AS n_lines, COALESCE(l_quantity, 0) AS l_quantity,
       COALESCE(l_extendedprice, 0) AS l_extendedprice
FROM orders LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n_lines, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
  FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
"""


def lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity",
                                                 "l_extendedprice")
    return regroup_sum(li, ["o_orderkey"], money=["l_quantity", "l_extendedprice"], row_count="n_lines")


@register("orders_lines_left", ORDERS_LINES_LEFT_SQL)
def q_orders_lines_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 (JON-1, SCA-13): orders LEFT JOIN their per-order line totals (pre-aggregated, one row per
    order, so the row count is kept); orders without lines get 0."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = left_join(orders, lines_per_order(spark, sf_dir), ["o_orderkey"])
    return fill_zero(joined, ["n_lines", "l_quantity", "l_extendedprice"]).select(
        "o_orderkey", "o_orderdate", "n_lines", "l_quantity", "l_extendedprice")


# --------------------------------------------------------------------------------------------- B10
FLATTEN_STATS_SQL = """
SELECT l_shipdate AS date, l_partkey AS nmId, l_returnflag || l_linestatus AS name,
       CAST(l_quantity AS BIGINT) AS views, CAST(l_linenumber AS BIGINT) AS clicks, l_discount AS ctr,
       l_tax AS cpc, l_extendedprice AS sum, l_suppkey AS atbs, CAST(1 AS BIGINT) AS orders, l_discount AS cr,
       CAST(l_linenumber AS BIGINT) AS shks, l_extendedprice AS sum_price, l_orderkey AS advertId
FROM lineitem
"""


@register("flatten_nested_stats", FLATTEN_STATS_SQL)
def q_flatten_nested_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 (PRJ-3): ad-statistics payloads ``{advertId, days[]{date, apps[]{appType, nm[]}}}`` read from JSON
    text and flattened through three ``inline`` levels. Stand-in: one payload per line (advertId = order,
    date = ship date as text with a +03:00 offset, one app with the line as product, a second app with an
    empty product list, which must vanish)."""
    li = table(spark, sf_dir, "lineitem")
    nm = F.struct(F.col("l_partkey").alias("nmId"), F.concat("l_returnflag", "l_linestatus").alias("name"),
                  F.col("l_quantity").cast("bigint").alias("views"), F.col("l_linenumber").cast("bigint").alias("clicks"),
                  F.col("l_discount").alias("ctr"), F.col("l_tax").alias("cpc"), F.col("l_extendedprice").alias("sum"),
                  F.col("l_suppkey").alias("atbs"), F.lit(1).cast("bigint").alias("orders"),
                  F.col("l_discount").alias("cr"), F.col("l_linenumber").cast("bigint").alias("shks"),
                  F.col("l_extendedprice").alias("sum_price"))
    empty_nm = F.filter(F.array(nm), lambda x: F.lit(False))
    day = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+03:00'").alias("date"),
                   F.array(F.struct(F.lit(1).alias("appType"), F.array(nm).alias("nm")),
                           F.struct(F.lit(2).alias("appType"), empty_nm.alias("nm"))).alias("apps"))
    payload = F.struct(F.col("l_orderkey").alias("advertId"), F.array(day).alias("days"))
    flat = ads.flatten_ad_stats(_json_payload(li, payload, AD_STATS))
    return flat.select("date", "nmId", "name", "views", "clicks", "ctr", "cpc", "sum", "atbs", "orders", "cr",
                       "shks", "sum_price", "advertId")


# --------------------------------------------------------------------------------------------- B11
FLATTEN_HISTORY_SQL = """
SELECT o_custkey AS nmID, 'customer-' || CAST(o_custkey AS VARCHAR) AS imtName, CAST(NULL AS VARCHAR) AS vendorCode,
       strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(1 AS INTEGER) AS openCardCount,
       CAST(NULL AS INTEGER) AS addToCartCount, CAST(NULL AS DOUBLE) AS addToCartConversion,
       CAST(1 AS INTEGER) AS ordersCount, o_totalprice AS ordersSumRub,
       CAST(NULL AS DOUBLE) AS cartToOrderConversion,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS buyoutsCount,
       CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS DOUBLE) AS buyoutsSumRub,
       CAST(NULL AS DOUBLE) AS buyoutPercent
FROM orders
"""


@register("flatten_history", FLATTEN_HISTORY_SQL)
def q_flatten_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 (PRJ-4): product-history payloads ``{error, data[]{nmID, imtName, vendorCode, history[]}}`` read
    from JSON text and flattened. Stand-in: a customer is the product, its orders are the history entries,
    nested in pages of bounded size; ``vendorCode`` and some counters are absent keys (null)."""
    o = table(spark, sf_dir, "orders")
    fin = F.col("o_orderstatus") == "F"
    entry = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), F.lit(1).alias("openCardCount"),
                     F.lit(1).alias("ordersCount"), F.col("o_totalprice").alias("ordersSumRub"),
                     F.when(fin, 1).otherwise(0).alias("buyoutsCount"),
                     F.when(fin, F.col("o_totalprice")).otherwise(0).cast("string").alias("buyoutsSumRub"))
    pages = standins.nest_pages(o, ["o_custkey"], entry, ["o_orderdate", "o_orderkey"])
    product = F.struct(F.col("o_custkey").alias("nmID"),
                       F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("imtName"),
                       F.col("items").alias("history"))
    payload = F.struct(F.lit(False).alias("error"), F.array(product).alias("data"))
    rows = ads.flatten_history(_json_payload(pages, payload, PRODUCT_HISTORY))
    return rows.select("nmID", "imtName", "vendorCode", "dt", "openCardCount", "addToCartCount",
                       "addToCartConversion", "ordersCount", "ordersSumRub", "cartToOrderConversion", "buyoutsCount",
                       "buyoutsSumRub", "buyoutPercent")


# --------------------------------------------------------------------------------------------- B12
FUNNEL_BEGIN = "2024-01-01 00:00:00"
FUNNEL_SQL = f"""
SELECT p_partkey AS nmID, p_name AS vendorCode, upper(lower(p_brand)) AS brandName, p_size AS objectID,
       p_type AS objectName, TIMESTAMP '{FUNNEL_BEGIN}' AS begin, CAST(n AS INTEGER) AS openCardCount,
       CAST(trunc(q) AS INTEGER) AS addToCartCount, CAST(n AS INTEGER) AS ordersCount,
       CAST(r AS DOUBLE) AS ordersSumRub, CAST(NULL AS INTEGER) AS buyoutsCount,
       CAST(NULL AS DOUBLE) AS buyoutsSumRub, CAST(NULL AS INTEGER) AS cancelCount,
       CAST(NULL AS DOUBLE) AS cancelSumRub, p_size AS stocksMp, CAST(NULL AS INTEGER) AS stocksWb,
       'parts' AS Project, 'Wildberries' AS Marketplace
FROM part LEFT JOIN (SELECT l_partkey, COUNT(*) AS n, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q,
                            SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS r
                     FROM lineitem GROUP BY l_partkey) l ON p_partkey = l_partkey
"""


@register("flatten_struct_paths", FUNNEL_SQL)
def q_flatten_struct_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 (JOB-8: PRJ-5/6, SCA-15, PRJ-12): funnel card pages read from JSON text, struct paths flattened,
    brand upper-cased, the 18 contract columns kept. Stand-in: one card per part with its line totals;
    parts without lines have no numbers (null), absent keys stay null."""
    part = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity",
                                                 "l_extendedprice")
    totals = regroup_sum(li, ["p_partkey"], money=["l_quantity", "l_extendedprice"], row_count="n",
                         keep_decimal=True)
    cards = left_join(part, totals, ["p_partkey"])
    period = F.struct(F.lit(FUNNEL_BEGIN).alias("begin"), F.col("n").cast("int").alias("openCardCount"),
                      F.col("l_quantity").cast("int").alias("addToCartCount"),
                      F.col("n").cast("int").alias("ordersCount"),
                      F.col("l_extendedprice").cast("double").alias("ordersSumRub"))
    card = F.struct(F.col("p_partkey").alias("nmID"), F.col("p_name").alias("vendorCode"),
                    F.lower("p_brand").alias("brandName"),
                    F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("name")).alias("object"),
                    F.struct(period.alias("selectedPeriod")).alias("statistics"),
                    F.struct(F.col("p_size").alias("stocksMp")).alias("stocks"))
    page = F.struct(F.struct(F.lit(1).alias("page"), F.lit(False).alias("isNextPage"),
                             F.array(card).alias("cards")).alias("data"))
    pages = _funnel_pages(cards, page)
    return funnel.funnel_daily(pages)


def _funnel_pages(cards: DataFrame, page) -> DataFrame:
    src = cards.select(F.lit("parts").alias("Project"), F.lit(MARKETPLACE_WB).alias("Marketplace"),
                       F.to_json(page).alias("payload"))
    return parse_json_text(src, "payload", FUNNEL_PAGE, ["Project", "Marketplace"])


# --------------------------------------------------------------------------------------------- B13
STOCK_SQL = f"""
SELECT s_name AS warehouseName, CAST(trunc(q) AS INTEGER) AS quantity, upper(lower(p_brand)) AS brand,
       p_type AS subjectName, p_name AS vendorCode, p_size AS inWayToClient, CAST(0 AS INTEGER) AS inWayFromClient,
       CAST(NULL AS INTEGER) AS quantityWarehousesFull, 'parts' AS Project, TIMESTAMP '{NOW}' AS Date,
       'Wildberries' AS Marketplace
FROM part
JOIN (SELECT l_partkey, l_suppkey, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem
      GROUP BY l_partkey, l_suppkey) l ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey
"""


@register("stock_by_warehouse", STOCK_SQL)
def q_stock_by_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13 (JOB-9: PRJ-2, SCA-14, PRJ-15/16): warehouse-remains payloads read from JSON text,
    ``warehouses[]`` exploded with the product columns (an empty list drops the product), brand upper-cased
    with '' for null, load time and marketplace stamped. Stand-in: a warehouse is a supplier of the part,
    its quantity the part's line quantity from that supplier; a part nobody supplied has an empty list."""
    part = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_quantity")
    per_supplier = regroup_sum(li, ["p_partkey", "l_suppkey"], money=["l_quantity"], keep_decimal=True)
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    stocked = per_supplier.join(supplier, "l_suppkey")
    rows = left_join(part, stocked, ["p_partkey"])
    wh = F.struct(F.col("s_name").alias("warehouseName"), F.col("l_quantity").cast("int").alias("quantity"))
    warehouses = F.when(F.col("s_name").isNull(), F.filter(F.array(wh), lambda x: F.lit(False))).otherwise(F.array(wh))
    payload = F.struct(F.lower("p_brand").alias("brand"), F.col("p_type").alias("subjectName"),
                       F.col("p_name").alias("vendorCode"), F.col("p_size").alias("inWayToClient"),
                       F.lit(0).alias("inWayFromClient"), warehouses.alias("warehouses"))
    remains = _json_payload(rows.withColumn("Project", F.lit("parts")), payload, WAREHOUSE_REMAINS, ["Project"])
    return stock.stock_snapshot(remains, NOW)


# --------------------------------------------------------------------------------------------- B14
FIRST_ITEM_SQL = """
WITH first_line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS rn
    FROM lineitem) t WHERE rn = 1)
SELECT 'orders' AS project, o_orderkey AS operation_id, o_orderstatus AS operation_type,
       o_orderdate AS operation_date, o_orderpriority AS operation_type_name,
       o_totalprice AS delivery_charge, CAST(0 AS DOUBLE) AS return_delivery_charge,
       CAST(0 AS DOUBLE) AS accruals_for_sale, CAST(0 AS DOUBLE) AS sale_commission, -o_totalprice AS amount,
       'orders' AS type, o_orderpriority AS posting_delivery_schema, o_orderdate AS posting_order_date,
       'P-' || CAST(o_orderkey AS VARCHAR) AS posting_posting_number, o_custkey AS posting_warehouse_id,
       CAST(f.l_linenumber AS VARCHAR) || '-' || CAST(f.l_partkey AS VARCHAR) || '-' || CAST(f.l_suppkey AS VARCHAR)
         AS item_name,
       COALESCE(f.l_partkey, 0) AS item_sku, CAST(NULL AS VARCHAR) AS service_name,
       CAST(NULL AS DOUBLE) AS service_price
FROM orders LEFT JOIN first_line f ON o_orderkey = f.l_orderkey
"""


@register("first_item", FIRST_ITEM_SQL)
def q_first_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B14 (SRC-9, JOB-13: PRJ-9/10, SCA-4/5): finance-operation payloads read from landed files; the first item of
    each operation (null when it has none), posting fields prefixed, text numbers cast with 0 for bad text.
    Stand-in: an order is an operation; its items are its earliest line's part and then that line's supplier."""
    o = table(spark, sf_dir, "orders")
    item = lambda name, sku: F.struct(name.alias("name"), sku.cast("string").alias("sku"))
    items = F.array(item(F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey"), F.col("l_partkey")),
                    item(F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")), F.col("l_suppkey")))
    li = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
          .agg(F.min(F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")).alias("line"))
          .select("o_orderkey", "line.*").select("o_orderkey", items.alias("items")))
    ops = left_join(o, li, ["o_orderkey"])
    when_text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    op = F.struct(
        F.col("o_orderkey").cast("string").alias("operation_id"), F.col("o_orderstatus").alias("operation_type"),
        when_text.alias("operation_date"), F.col("o_orderpriority").alias("operation_type_name"),
        F.col("o_totalprice").cast("string").alias("delivery_charge"), F.lit("").alias("accruals_for_sale"),
        F.col("o_orderpriority").alias("sale_commission"), (-F.col("o_totalprice")).cast("string").alias("amount"),
        F.lit("orders").alias("type"),
        F.struct(F.col("o_orderpriority").alias("delivery_schema"), when_text.alias("order_date"),
                 F.concat(F.lit("P-"), F.col("o_orderkey").cast("string")).alias("posting_number"),
                 F.col("o_custkey").alias("warehouse_id")).alias("posting"),
        F.col("items").alias("items"))
    payload = F.struct(F.struct(F.array(op).alias("operations")).alias("result"))
    return finance.finance_operations(standins.landed(ops, "operations", F.to_json(payload), FINANCE_OPERATIONS), project="orders")


# --------------------------------------------------------------------------------------------- B15
REPORT_DAY = "2024-03-05"
RECURSIVE_SQL = f"""
SELECT p_name AS item_offer_id, p_type AS item_name, p_partkey AS item_sku,
       p_size AS delivery_commission_quantity, p_retailprice AS delivery_commission_amount,
       CAST(NULL AS DOUBLE) AS delivery_commission_bonus, CAST(0 AS INTEGER) AS return_commission_quantity,
       CAST(NULL AS DOUBLE) AS return_commission_amount, p_retailprice AS prices_0,
       CAST(p_size AS DOUBLE) AS prices_1, '2024-3-5' AS date
FROM part
"""


@register("recursive_flatten", RECURSIVE_SQL)
def q_recursive_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 (JOB-14: PRJ-8, FLT-10, SCA-19/20): realization-by-day payloads read from JSON text; every leaf
    becomes a ``_``-joined column, the declared 2-element price array becomes ``prices_0``/``prices_1``;
    ``date`` is the request day as unpadded text. Stand-in: one report row per part."""
    part = table(spark, sf_dir, "part")
    row = F.struct(
        F.struct(F.col("p_name").alias("offer_id"), F.col("p_type").alias("name"),
                 F.col("p_partkey").alias("sku")).alias("item"),
        F.struct(F.col("p_size").alias("quantity"), F.col("p_retailprice").alias("amount")).alias("delivery_commission"),
        F.struct(F.lit(0).alias("quantity")).alias("return_commission"),
        F.array(F.col("p_retailprice"), F.col("p_size").cast("double")).alias("prices"))
    payloads = _json_payload(part.withColumn("day", F.lit(REPORT_DAY).cast("date")),
                             F.struct(F.array(row).alias("rows")), REALIZATION_BY_DAY, ["day"])
    out = finance.realization_by_day(payloads, "day", array_sizes={"prices": 2})
    return out.drop("error", "message")


# --------------------------------------------------------------------------------------------- B16
PARSE_JSON_SQL = """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       COALESCE(CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT), 0) AS k,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double
FROM events
"""


@register("parse_json_metric", PARSE_JSON_SQL)
def q_parse_json_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B16 (SCA-3/4): a metric inside JSON text, taken as text, cast tolerantly to double and to int64."""
    ev = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k_text"))
    return ev.select("event_id", "k_text", to_long_or_zero("k_text").alias("k"), to_double("k_text").alias("k_double"))


# --------------------------------------------------------------------------------------------- B17
TOLERANT_SQL = """
SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS name_as_double,
       COALESCE(CAST(trunc(TRY_CAST(p_name AS DOUBLE)) AS BIGINT), 0) AS name_as_long,
       CAST(p_size AS DOUBLE) AS size_as_double, CAST(p_size AS BIGINT) AS size_as_long,
       CAST(trunc(p_retailprice) AS BIGINT) AS price_as_long, TRY_CAST(p_name AS TIMESTAMP) AS name_as_time
FROM part
"""


@register("tolerant_cast", TOLERANT_SQL)
def q_tolerant_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B17 (SCA-3/4/5): tolerant casts of text: a never-numeric name gives null (double), 0 (int64) and null
    (timestamp); numbers as text parse; a price as text truncates to int64."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_size").cast("string").alias("size_text"),
                                           F.col("p_retailprice").cast("string").alias("price_text"))
    return p.select("p_partkey", to_double("p_name").alias("name_as_double"),
                    to_long_or_zero("p_name").alias("name_as_long"), to_double("size_text").alias("size_as_double"),
                    to_long_or_zero("size_text").alias("size_as_long"),
                    to_long_or_zero("price_text").alias("price_as_long"),
                    to_wall_clock("p_name").alias("name_as_time"))


# --------------------------------------------------------------------------------------------- B18
TAIL_SQL = """
SELECT page_id, url, regexp_extract(NULLIF(url, ''), '[^/]*$') AS tail
FROM pages
"""


@register("text_after_marker", TAIL_SQL)
def q_text_after_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B18 (SCA-18): the text after the last marker ('/'): null for missing or empty text, the whole text
    when the marker is absent, '' when nothing follows it."""
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    return pg.select("page_id", "url", text_after_last("url", "/").alias("tail"))


# --------------------------------------------------------------------------------------------- B20
ROW_JSON_SQL = f"""
SELECT TIMESTAMP '{NOW}' AS moment, 'nation' AS assortment_type, CAST(n_nationkey AS VARCHAR) AS assortment_code,
       n_name AS assortment_name, CAST(NULL AS VARCHAR) AS assortment_gtin, CAST(NULL AS VARCHAR) AS assortment_brand,
       'active' AS assortment_state, CAST(n_regionkey AS VARCHAR) AS assortment_folder,
       CAST(NULL AS DOUBLE) AS assortment_volume, CAST(n_nationkey AS DOUBLE) AS stock_stock,
       CAST(0 AS DOUBLE) AS stock_transit, CAST(0 AS DOUBLE) AS stock_reserve,
       CAST(n_nationkey AS DOUBLE) AS stock_quantity, CAST(NULL AS DOUBLE) AS stock_days,
       CAST(n_regionkey AS DOUBLE) AS stock_cost,
       n_name AS json_name, CAST(n_nationkey AS VARCHAR) AS json_code, '{NOW.replace(' ', 'T')}' AS json_moment,
       CAST(15 AS INTEGER) AS json_keys
FROM nation
"""


@register("row_to_json", ROW_JSON_SQL)
def q_row_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B20 (SRC-16, JOB-10: PRJ-7, PRJ-19, SCA-6): ERP stock payloads from landed files flattened, renamed to underscore names, the
    whole item serialised to JSON with nulls written; the JSON is checked by parsing fields back (all 15
    keys present, nulls included). Stand-in: one stock item per nation."""
    nation = table(spark, sf_dir, "nation")
    item = F.struct(
        F.lit(NOW.replace(" ", "T")).alias("moment"),
        F.struct(F.lit("nation").alias("type"), F.col("n_nationkey").cast("string").alias("code"),
                 F.col("n_name").alias("name"), F.lit("active").alias("state"),
                 F.col("n_regionkey").cast("string").alias("folder")).alias("assortment"),
        F.struct(F.col("n_nationkey").cast("double").alias("stock"), F.lit(0.0).alias("transit"),
                 F.lit(0.0).alias("reserve"), F.col("n_nationkey").cast("double").alias("quantity"),
                 F.col("n_regionkey").cast("double").alias("cost")).alias("stock"))
    page = F.to_json(F.struct(F.array(item).alias("stocks")))
    snap = stock.erp_stock_snapshot(standins.landed(nation, "erp-stock", page, ERP_STOCK))
    parsed = F.from_json("metadata_json", "moment string, `assortment.name` string, `assortment.code` string")
    return snap.select("*", parsed.getField("assortment.name").alias("json_name"),
                       parsed.getField("assortment.code").alias("json_code"),
                       parsed.getField("moment").alias("json_moment"),
                       F.size(F.json_object_keys("metadata_json")).alias("json_keys")).drop("metadata_json")


# --------------------------------------------------------------------------------------------- B21
CAL_END, CAL_DAYS = "2024-01-31", 31
CALENDAR_SQL = f"""
SELECT CAST(d AS DATE) AS day, COALESCE(n_events, 0) AS n_events, COALESCE(spend, 0) AS spend
FROM generate_series(DATE '{CAL_END}' - {CAL_DAYS - 1}, DATE '{CAL_END}', INTERVAL 1 DAY) g(d)
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_events,
                  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend
           FROM events GROUP BY CAST(ts AS DATE)) e ON CAST(d AS DATE) = e.day
"""


@register("calendar_fill", CALENDAR_SQL)
def q_calendar_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B21 (SCA-23, JON-1, SCA-13): a 31-day calendar ending at a fixed day, LEFT JOIN daily event counts
    and spend, 0 for days without events. The daily side is filtered to the calendar first, so it has at
    most 31 rows: a proven bound, hence a broadcast."""
    cal = calendar(spark, CAL_END, CAL_DAYS)
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    ev = ev.filter(F.col("day").between(F.date_sub(F.lit(CAL_END).cast("date"), CAL_DAYS - 1),
                                        F.lit(CAL_END).cast("date")))
    daily = regroup_sum(ev.withColumnRenamed("value", "spend"), ["day"], money=["spend"], row_count="n_events")
    out = left_join(cal, F.broadcast(daily), ["day"])
    return fill_zero(out, ["n_events", "spend"]).select("day", "n_events", "spend")


# --------------------------------------------------------------------------------------------- B22
PREV_WEEK_SQL = """
SELECT o_orderkey, o_orderdate, CAST(date_trunc('week', o_orderdate) AS DATE) - 7 AS week_start,
       CAST(date_trunc('week', o_orderdate) AS DATE) - 1 AS week_end
FROM orders
"""


@register("previous_week", PREV_WEEK_SQL)
def q_previous_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B22 (SCA-22): Monday and Sunday of the calendar week before each order date."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", "o_orderdate", previous_week_start("o_orderdate").alias("week_start"),
                    previous_week_end("o_orderdate").alias("week_end"))


# --------------------------------------------------------------------------------------------- B23
DATE_TEXT_SQL = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%-m-%-d') AS date_text, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day_of_month,
       strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS day_start, strftime(o_orderdate, '%Y-%m-%d 23:59:59') AS day_end,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(millisecond(o_orderdate) % 1000 AS VARCHAR), 3, '0')
         || 'Z' AS iso_utc,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start
FROM orders
"""


@register("date_text_parts", DATE_TEXT_SQL)
def q_date_text_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B23 (SCA-19/20/21): unpadded date text, year/month/day, formatted request bounds, year start."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    return o.select("o_orderkey", unpadded_date_text(d).alias("date_text"),
                    *[c.alias(n) for n, c in date_parts(d).items()],
                    day_start_text(d).alias("day_start"), day_end_text(d).alias("day_end"),
                    iso_utc_text(d).alias("iso_utc"), year_start(d).alias("year_start"))


# --------------------------------------------------------------------------------------------- B24
SENTINEL_SQL = """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN l_returnflag = 'R' AND l_shipdate BETWEEN TIMESTAMP '1677-09-22' AND TIMESTAMP '2262-04-11'
            THEN l_shipdate ELSE TIMESTAMP '2100-01-01' END AS return_date
FROM lineitem
"""


@register("sentinel_date", SENTINEL_SQL)
def q_sentinel_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B24 (SCA-10): a return date only for returned lines, else the 2100-01-01 sentinel."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    ret = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", date_or_sentinel(ret).alias("return_date"))


# --------------------------------------------------------------------------------------------- B25
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LATEST_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                            l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                                            l_linestatus DESC) AS rn
      FROM lineitem) t
WHERE rn = 1
"""


@register("latest_version", LATEST_SQL)
def q_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B25 (WIN-1): one row per (order, line): the latest ship date wins, ties broken by every other column."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return latest_version(li, ["l_orderkey", "l_linenumber"], "l_shipdate")


# --------------------------------------------------------------------------------------------- B26
PERIOD_CHANGE_SQL = """
WITH w AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, COUNT(*) AS ordered
           FROM events GROUP BY user_id, CAST(date_trunc('week', ts) AS DATE)),
l AS (SELECT user_id, week, ordered,
             lag(week) OVER (PARTITION BY user_id ORDER BY week) AS pw,
             lag(ordered) OVER (PARTITION BY user_id ORDER BY week) AS po
      FROM w),
c AS (SELECT user_id, week, ordered, CASE WHEN pw = week - 7 THEN po END AS prev_ordered FROM l)
SELECT * FROM (SELECT user_id, week, ordered, prev_ordered,
                      ROUND(CASE WHEN prev_ordered <> 0 THEN ordered / prev_ordered - 1 END, 6) AS change FROM c) t
WHERE ordered > 5 AND change < -0.5
"""


@register("period_change", PERIOD_CHANGE_SQL)
def q_period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B26 (JOB-19: WIN-2, FLT-4): weekly event counts per product (user), change against the immediately
    preceding week, then the products with more than 5 whose count fell by more than half."""
    ev = table(spark, sf_dir, "events")
    weekly = ev.groupBy("user_id", F.trunc(F.to_date("ts"), "week").alias("week")).agg(
        F.count(F.lit(1)).alias("ordered"))
    return stock.stock_alert_falling_sales(weekly, ["user_id"], "week", "ordered", lambda w: F.date_sub(w, 7))


# --------------------------------------------------------------------------------------------- B27
OUT_OF_STOCK_SQL = """
SELECT o_orderkey, CAST(COALESCE(n, 0) AS VARCHAR) AS stock
FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
WHERE COALESCE(n, 0) = 0
"""


@register("out_of_stock", OUT_OF_STOCK_SQL)
def q_out_of_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B27 (JOB-19: FLT-3): products whose numeric-coerced stock text is 0. Stand-in sheet: an order is the
    product, its number of lines (as text) the stock."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    n = lines_per_order(spark, sf_dir).select("o_orderkey", "n_lines")
    sheet = fill_zero(left_join(orders, n, ["o_orderkey"]), ["n_lines"])
    sheet = sheet.select("o_orderkey", F.col("n_lines").cast("string").alias("stock"))
    return stock.stock_alert_out_of_stock(sheet, "stock")


# --------------------------------------------------------------------------------------------- B28
DISTINCT_DAYS_SQL = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC"


@register("distinct_days_desc", DISTINCT_DAYS_SQL)
def q_distinct_days_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B28 (AGG-6, SRT-2): the distinct days, newest first."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return sort_desc(days, "day")


# --------------------------------------------------------------------------------------------- B29
CAMPAIGNS_SQL = "SELECT COUNT(DISTINCT l_suppkey) AS n_campaigns FROM lineitem"
TOTAL_QTY_SQL = "SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity FROM lineitem"
PRODUCT_ID = 42
ONE_PRODUCT_SQL = f"""
SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem WHERE l_partkey = {PRODUCT_ID}
"""


@register("distinct_campaigns", CAMPAIGNS_SQL)
def q_distinct_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B29 (AGG-4): exact distinct count of campaigns (suppliers stand in for campaigns)."""
    return distinct_count(table(spark, sf_dir, "lineitem"), "l_suppkey", "n_campaigns")


@register("total_quantity", TOTAL_QTY_SQL)
def q_total_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B29 (AGG-2): global sum (order-independent decimal)."""
    return total(table(spark, sf_dir, "lineitem"), "l_quantity", "total_quantity", money_scale=2)


@register("one_product_sum", ONE_PRODUCT_SQL)
def q_one_product_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B29 (AGG-3, FLT-2): revenue of one product (equality filter pushed into the scan)."""
    return filtered_total(table(spark, sf_dir, "lineitem"), "l_extendedprice", F.col("l_partkey") == PRODUCT_ID,
                          "revenue", money_scale=2)


# --------------------------------------------------------------------------------------------- B30
TOP_K = 10
TOP_SQL = f"""
SELECT t.l_partkey AS p_partkey, p_name, revenue
FROM (SELECT l_partkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
      FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT {TOP_K}) t
JOIN part ON p_partkey = t.l_partkey
"""


@register("top_products", TOP_SQL)
def q_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B30 (SRT-3): the k products with the highest revenue (ties by product key); names are joined after
    the top-k, so only k rows meet the part table (k rows: a proven broadcast bound)."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    revenue = regroup_sum(li, ["p_partkey"], money=["l_extendedprice"]).withColumnRenamed("l_extendedprice", "revenue")
    top = F.broadcast(top_k(revenue, "revenue", TOP_K, ["p_partkey"]))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").join(top, "p_partkey").select(
        "p_partkey", "p_name", "revenue")


# --------------------------------------------------------------------------------------------- B31
PARTY_CONTRACT = [("Project", "string"), ("key", "bigint"), ("name", "string"), ("nationkey", "int"),
                  ("acctbal", "double"), ("segment", "string"), ("phone", "string")]
UNION_SQL = """
SELECT 'customers' AS Project, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS phone FROM customer
UNION ALL
SELECT 'suppliers', s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
FROM supplier
"""


@register("union_projects", UNION_SQL)
def q_union_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B31 (SET-1, PRJ-15/17/18): two projects with different columns unioned by name (missing columns null),
    tagged with their project, then conformed to a contract with a column neither has."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                               F.col("c_nationkey").alias("nationkey"),
                                               F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                               F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return conform(union_projects({"customers": c, "suppliers": s}), PARTY_CONTRACT)


# --------------------------------------------------------------------------------------------- B35
REGROUP_SQL = """
SELECT p_brand AS brand, p_type AS subjectName, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       COUNT(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_type
"""


@register("stock_regroup", REGROUP_SQL)
def q_stock_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B35 (AGG-9): finer rows regrouped to (brand, subject) with quantity sums. Lines are pre-aggregated
    per part before the join, so the join and the regroup see one row per part instead of every line."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    per_part = regroup_sum(li, ["p_partkey"], money=["l_quantity"], row_count="n_lines", keep_decimal=True)
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"),
                                              F.col("p_type").alias("subjectName"))
    joined = per_part.join(part, "p_partkey")
    out = joined.groupBy("brand", "subjectName").agg(F.sum("l_quantity").cast("double").alias("quantity"),
                                                    F.sum("n_lines").alias("n_lines"))
    return out


# --------------------------------------------------------------------------------------------- B37
ROWS_PER_PROJECT_SQL = "SELECT c_mktsegment AS project, COUNT(*) AS n_rows FROM customer GROUP BY c_mktsegment"
ONE_PROJECT = "BUILDING"
ONE_PROJECT_SQL = f"SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = {lit(ONE_PROJECT)}"


@register("rows_per_project", ROWS_PER_PROJECT_SQL)
def q_rows_per_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B37 (AGG-8): row count per project (market segment stands in for project)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("project"))
    return rows_per_project(c, "project")


@register("one_project", ONE_PROJECT_SQL)
def q_one_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B37 (FLT-1): rows of one project (equality filter pushed into the scan)."""
    return equals(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                  "c_mktsegment", ONE_PROJECT)


# --------------------------------------------------------------------------------------------- B38
def _realization_sql() -> str:
    mapped = {
        "realizationreport_id": "l_orderkey", "rrd_id": "CAST(l_linenumber AS BIGINT)", "nm_id": "l_partkey",
        "quantity": "CAST(l_quantity AS BIGINT)", "retail_price": "l_extendedprice", "commission_percent": "l_tax",
        "doc_type_name": "l_returnflag", "supplier_oper_name": "l_linestatus",
        "brand_name": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END",
        "rr_dt": "l_shipdate", "order_dt": "l_shipdate",
        "srv_dbs": "CAST(l_returnflag = 'R' AS INTEGER)", "is_legal_entity": "CAST(l_linestatus = 'O' AS INTEGER)",
        "load_dt": f"TIMESTAMP '{NOW}'", "source": lit(REALIZATION_SOURCE), "project": "'lines'",
    }
    duck = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    cols = [f"{mapped[c]} AS {c}" if c in mapped else f"CAST(NULL AS {duck[t]}) AS {c}" for c, t in WB_FINANCE]
    return "SELECT " + ", ".join(cols) + " FROM lineitem"


@register("realization_clean", _realization_sql())
def q_realization_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B38 (JOB-12: SCA-5/7/11/16, PRJ-15/16/17/18): realization rows cleaned into the 76-column contract:
    '' to null, dates parsed with the offset dropped, flags to 0/1, fixed load time, project and source,
    absent columns null. Stand-in rows: a line is a report row; brand '' for unreturned lines; dates as
    text with +03:00 / Z offsets; empty date_from text."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_orderkey").alias("realizationreport_id"), F.col("l_linenumber").cast("bigint").alias("rrd_id"),
        F.col("l_partkey").alias("nm_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("retail_price"), F.col("l_tax").alias("commission_percent"),
        F.col("l_returnflag").alias("doc_type_name"), F.col("l_linestatus").alias("supplier_oper_name"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag")).alias("brand_name"),
        F.lit("").alias("date_from"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+03:00'").alias("rr_dt"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_dt"),
        (F.col("l_returnflag") == "R").alias("srv_dbs"), (F.col("l_linestatus") == "O").alias("is_legal_entity"))
    return finance.realization_clean(rows, NOW, project="lines")


# ------------------------------------------------------------------------------------ JOB-16, JOB-18
OBJECTS_SQL = "SELECT CAST(o_custkey AS VARCHAR) AS campaign_id, CAST(o_orderkey AS VARCHAR) AS object_id FROM orders"


@register("campaign_objects", OBJECTS_SQL)
def q_campaign_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12, JOB-16 (PRJ-11): per-campaign object lists read from landed files and exploded to (campaign, object).
    Stand-in: a customer is a campaign, its orders are its objects (pages of bounded size)."""
    o = table(spark, sf_dir, "orders")
    pages = standins.nest_pages(o, ["o_custkey"], F.struct(F.col("o_orderkey").cast("string").alias("id")),
                                ["o_orderkey"])
    page = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("campaign_id"), F.col("items").alias("list")))
    lists = standins.landed(pages, "objects", page, f"campaign_id string, {CAMPAIGN_OBJECTS}")
    return performance.campaign_objects(lists)


ERP_PROFIT_SQL = """
SELECT p_name AS product_name, CAST(p_partkey AS VARCHAR) AS product_code, p_type AS product_article,
       'pcs' AS product_uom, 'https://erp.example/entity/product/' || CAST(p_partkey AS VARCHAR) AS product_href,
       CAST(p_partkey AS VARCHAR) AS product_uuid, CAST(p_size AS DOUBLE) AS sell_quantity,
       p_retailprice AS sell_price, CAST(NULL AS DOUBLE) AS sell_sum, CAST(NULL AS DOUBLE) AS sell_cost_sum,
       CAST(NULL AS DOUBLE) AS return_quantity, CAST(NULL AS DOUBLE) AS return_sum, CAST(NULL AS DOUBLE) AS profit,
       CAST(NULL AS DOUBLE) AS margin, CAST(NULL AS DOUBLE) AS sales_margin
FROM part
"""


@register("erp_profit", ERP_PROFIT_SQL)
def q_erp_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15, JOB-18 (PRJ-6, SCA-18): ERP profit rows read from landed files, nested paths flattened with absent keys
    null, the uuid taken after the last 'id='. Stand-in: one profit row per part."""
    part = table(spark, sf_dir, "part")
    row = F.struct(
        F.struct(F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("code"),
                 F.col("p_type").alias("article"), F.struct(F.lit("pcs").alias("name")).alias("uom"),
                 F.struct(F.concat(F.lit("https://erp.example/entity/product/"), F.col("p_partkey").cast("string")).alias("href"),
                          F.concat(F.lit("https://erp.example/app/#good/edit?id="),
                                   F.col("p_partkey").cast("string")).alias("uuidHref")).alias("meta")).alias("assortment"),
        F.col("p_size").cast("double").alias("sellQuantity"), F.col("p_retailprice").alias("sellPrice"))
    return erp.erp_profit(standins.landed(part, "erp-profit", F.to_json(F.struct(F.array(row).alias("rows"))), ERP_PROFIT))

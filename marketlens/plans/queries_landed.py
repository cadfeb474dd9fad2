"""Registered queries over landed files: JSON pages under ``project=/day=`` folders in the shared folder, read by the typed
readers, pruned, flattened and loaded; and the small operators that no job query shows by itself.

The stand-ins here land pages: several elements an array, several pages a day, one failed and one truncated page.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import nan_to_null, with_default
from ..functions.labels import AUDIT_ERROR, AUDIT_OK, MARKETPLACE_WB, REALIZATION_SOURCE
from ..operators import filters, setops, sort
from ..operators.aggregate import distinct_values
from ..operators.flatten import recursive_flatten
from ..operators.project import row_to_json
from ..operators.quality import load_audit, response_audit
from ..schemas import (AD_STATS, CAMPAIGN_COUNTS, CAMPAIGN_DETAILS, FUNNEL_PAGE, LOAD_AUDIT, ORDER_HISTORY_WB, PRODUCT_HISTORY,
                       PRODUCT_STATS_COLUMNS, REALIZATION_REPORT, SUPPLIER_ORDERS, WAREHOUSE_DATA_WB, WAREHOUSE_REMAINS, WB_REALIZATION_REPORTS)
from ..session import scratch_path
from ..sinks import writers
from ..sources.landed import landed_responses, parse_json_text, read_landed, read_report_folder, split_corrupt
from ..sources.tables import table
from . import ads, finance, funnel, performance, standins, stock
from .catalog import register
from .orders import orders_target, orders_upsert
from .queries_sinks import _orders_upsert_sql
from .standins import land, land_text

NOW = "2024-02-01 06:00:00"


# ------------------------------------------------------------------------------- SRC-3, SET-3, FLT-9, FLT-10
STATS_FIRST, STATS_LAST = "2024-01-05", "2024-01-20"
LANDED_STATS_SQL = f"""
SELECT 'events' AS Project, CAST(date AS DATE) AS day, nmId, CAST(ascii(advertId) AS BIGINT) AS advertId,
       CAST(SUM(views) AS BIGINT) AS views, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(CAST(sum AS DECIMAL(38,10))) AS DOUBLE) AS sum, CAST(SUM(orders) AS BIGINT) AS orders,
       CAST(SUM(CAST(sum_price AS DECIMAL(38,10))) AS DOUBLE) AS sum_price
FROM ({standins.AD_STATS_ROWS_SQL}) s WHERE CAST(date AS DATE) BETWEEN DATE '{STATS_FIRST}' AND DATE '{STATS_LAST}'
GROUP BY CAST(date AS DATE), nmId, ascii(advertId)
"""


def landed_stats(spark: SparkSession, sf_dir: str) -> str:
    rows = standins.ad_stats_rows(table(spark, sf_dir, "events")).select(
        F.to_date("date").alias("day"), F.ascii("advertId").alias("advertId"), "nmId", "views", "clicks", "sum", "orders", "sum_price", "name")
    # Numbers as JSON numbers and, for the money, as text: both must survive.
    nm = F.struct("nmId", "name", "views", "clicks", F.col("sum").cast("string").alias("sum"), "orders", "sum_price")
    pages = standins.nest_pages(rows, ["day", "advertId"], nm, ["nmId", "name"]).withColumn("project", F.lit("events"))
    apps = F.array(F.struct(F.lit(1).alias("appType"), F.slice("items", 1, 3).alias("nm")),
                   F.struct(F.lit(32).alias("appType"), F.filter("items", lambda x, i: i >= 3).alias("nm")))
    days = F.array(F.struct(F.date_format("day", "yyyy-MM-dd'T'00:00:00'+03:00'").alias("date"), apps.alias("apps")))
    path = land(pages, "ad-stats", F.to_json(F.struct("advertId", days.alias("days"))))
    land_text(spark, path, "events", "2024-01-06", "{}")
    land_text(spark, path, "events", "2024-01-06", '{"advertId": 99, "days": [{"date": "2024-01-06T00:0')
    return path


@register("landed_ad_stats", LANDED_STATS_SQL)
def q_landed_ad_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, SET-3, FLT-9, PRJ-3, AGG-1: ad-statistics pages of several products and apps from files, a window of days only (other
    days' folders are not read), sound pages flattened and grouped. An empty and a truncated page give no rows."""
    pages = read_landed(spark, landed_stats(spark, sf_dir), AD_STATS, multi_line=False, keep_corrupt=True)
    sound, _ = split_corrupt(filters.day_between(pages, "day", STATS_FIRST, STATS_LAST))
    flat = ads.flatten_ad_stats(sound.withColumnsRenamed({"project": "Project"}).drop("day"), keep=["Project"])
    return ads.ad_daily_fact(flat).select("Project", "day", "nmId", "advertId", "views", "clicks", "sum", "orders", "sum_price")


# Damaged pages by project and day: several on one day, and one on a day that has no sound page.
DAMAGED = [("shop-a", "2024-01-06", '{"advertId": 99, "days": [{"date": "2024-01-06T00:0'), ("shop-a", "2024-01-06", "<html>502</html>"),
           ("shop-b", "2024-03-10", '{"advertId": 7, "days": ['), ("shop-b", "2024-12-31", "too many requests")]
SHOP_B_SHIFT = 60  # days by which the second project's days lie later
LANDED_AUDIT_SQL = f"""
SELECT project AS API, day, CAST(COUNT(*) AS BIGINT) AS "Pages", 200 AS "Status Code", '{AUDIT_OK}' AS "Status", CAST(NULL AS VARCHAR) AS "Response Text",
       TIMESTAMP '{NOW}' AS "Date"
FROM (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'shop-a' ELSE 'shop-b' END AS project,
             CAST(CAST(ts AS DATE) + CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE {SHOP_B_SHIFT} END AS DATE) AS day FROM events) e
GROUP BY project, day
UNION ALL
SELECT c1, CAST(c2 AS DATE), CAST(1 AS BIGINT), 500, '{AUDIT_ERROR}', c3, TIMESTAMP '{NOW}' FROM (VALUES {", ".join(f"('{p}', '{d}', '{t}')" for p, d, t in DAMAGED)}) v(c1, c2, c3)
"""


@register("landed_audit", LANDED_AUDIT_SQL)
def q_landed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11, SCA-24, FLT-10: the load audit of the landed ad statistics of two projects with different days: the sound pages of each file, and
    each damaged page with its text. Project, day and file come from the responses themselves. The files of a day are added up here, as
    their number depends on how a folder was written."""
    own = F.col("event_type").isin("click", "view")
    rows = standins.ad_stats_rows(table(spark, sf_dir, "events")).withColumn("event_type", F.col("advertId"))
    day = F.date_add(F.to_date("date"), F.when(own, 0).otherwise(SHOP_B_SHIFT))
    nm = F.struct("nmId", "name", "views", "clicks", F.col("sum").cast("string").alias("sum"), "orders", "sum_price")
    apps = F.array(F.struct(F.lit(1).alias("appType"), F.array(nm).alias("nm")))
    body = F.to_json(F.struct(F.ascii("advertId").alias("advertId"), F.array(F.struct(F.col("date").cast("string").alias("date"), apps.alias("apps"))).alias("days")))
    path = land(rows.withColumns({"project": F.when(own, "shop-a").otherwise("shop-b"), "day": day}), "ad-stats-projects", body)
    for project, at, text in DAMAGED:
        land_text(spark, path, project, at, text)
    audit = response_audit(landed_responses(spark, path, AD_STATS, multi_line=False), NOW)
    return audit.groupBy("API", "day", "Status Code", "Status", "Response Text", "Date").agg(F.sum("Pages").alias("Pages"))


# -------------------------------------------------------------------------------------------- SRC-4, JOB-3, FLT-10
LANDED_HISTORY_SQL = """
SELECT o_custkey AS nmId, CAST(o_orderdate AS DATE) AS day, CAST(COUNT(*) AS INTEGER) AS ordersCount,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ordersSumRub, CAST(0 AS INTEGER) AS addToCartCount
FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
"""


@register("landed_history", LANDED_HISTORY_SQL)
def q_landed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4, PRJ-4, SCA-3, FLT-10: product-history pages from files, with money as JSON numbers and as text, fractions kept; failed
    pages are skipped. Stand-in: a customer is a product, its days with orders are the history."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    money = F.when(F.col("n") > 1, F.col("total").cast("string"))
    entry = F.struct(F.date_format("d", "yyyy-MM-dd").alias("dt"), F.col("n").cast("string").alias("ordersCount"),
                     F.coalesce(money, F.col("total").cast("string")).alias("ordersSumRub"), F.lit(0).alias("addToCartCount"))
    pages = standins.nest_pages(o, ["o_custkey"], entry, ["d"]).withColumns({"project": F.lit("p"), "day": F.lit("2024-02-01")})
    product = F.struct(F.col("o_custkey").alias("nmID"), F.lit("x").alias("imtName"), F.col("items").alias("history"))
    path = land(pages, "history", F.to_json(F.struct(F.lit(False).alias("error"), F.array(product).alias("data"))))
    land_text(spark, path, "p", "2024-02-01", '{"error": true, "errorText": "limit", "data": [{"nmID": 1, "history": [{"dt": "2024-01-01", "ordersCount": 7}]}]}')
    rows = ads.flatten_history(read_landed(spark, path, PRODUCT_HISTORY, multi_line=False))
    return ads.product_day_orders_from_history(rows)


# -------------------------------------------------------------------------------------------- SRC-5, JOB-4, JOB-8, SNK-1
CARDS_BEGIN = "2024-01-01 00:00:00"
CARDS_SQL = f"""
SELECT p_partkey AS nmID, p_name AS vendorCode, upper(p_brand) AS brandName, p_size AS objectID, p_type AS objectName,
       TIMESTAMP '{CARDS_BEGIN}' AS begin, p_size AS openCardCount, CAST(2 AS INTEGER) AS addToCartCount, CAST(1 AS INTEGER) AS ordersCount,
       p_retailprice AS ordersSumRub, CAST(NULL AS INTEGER) AS buyoutsCount, CAST(NULL AS DOUBLE) AS buyoutsSumRub,
       CAST(NULL AS INTEGER) AS cancelCount, CAST(NULL AS DOUBLE) AS cancelSumRub, p_size AS stocksMp, CAST(NULL AS INTEGER) AS stocksWb,
       'parts' AS Project, 'Wildberries' AS Marketplace
FROM part
"""


def landed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funnel card pages (several cards a page) from files."""
    period = F.struct(F.lit(CARDS_BEGIN).alias("begin"), F.col("p_size").alias("openCardCount"), F.lit("2").alias("addToCartCount"),
                      F.lit(1).alias("ordersCount"), F.col("p_retailprice").alias("ordersSumRub"))
    card = F.struct(F.col("p_partkey").alias("nmID"), F.col("p_name").alias("vendorCode"), F.lower("p_brand").alias("brandName"),
                    F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("name")).alias("object"),
                    F.struct(period.alias("selectedPeriod")).alias("statistics"), F.struct(F.col("p_size").alias("stocksMp")).alias("stocks"))
    pages = standins.nest_pages(table(spark, sf_dir, "part"), ["p_brand"], card, ["p_partkey"], page_size=16)
    body = F.struct(F.struct(F.lit(1).alias("page"), F.lit(False).alias("isNextPage"), F.col("items").alias("cards")).alias("data"))
    path = land(pages.withColumns({"project": F.lit("parts"), "day": F.lit("2024-01-02")}), "cards", F.to_json(body))
    pages = read_landed(spark, path, FUNNEL_PAGE, multi_line=False)
    return pages.withColumnsRenamed({"project": "Project"}).withColumn("Marketplace", F.lit(MARKETPLACE_WB))


@register("landed_funnel", CARDS_SQL)
def q_landed_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5, JOB-8, SNK-1: funnel cards from files, flattened and appended to ``order_history_wb``; read back."""
    target = writers.Target(scratch_path(spark, "order-history-wb"), ORDER_HISTORY_WB)
    writers.create_table(spark, target)
    writers.append(spark, funnel.funnel_daily(landed_cards(spark, sf_dir)), target)
    return writers.read(spark, target)


CARD_ORDERS_SQL = f"""
SELECT p_partkey AS nmId, DATE '{CARDS_BEGIN[:10]}' AS day, CAST(1 AS INTEGER) AS ordersCount, p_retailprice AS ordersSumRub,
       CAST(2 AS INTEGER) AS addToCartCount
FROM part
"""


@register("orders_from_cards", CARD_ORDERS_SQL)
def q_orders_from_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-4 (PRJ-5, JON-4 by renaming): product-day orders taken from funnel cards instead of the history."""
    return ads.product_day_orders_from_cards(ads.flatten_funnel_cards(landed_cards(spark, sf_dir)))


# ------------------------------------------------------------------------------------------ SRC-1, SRC-2, JOB-2, PRJ-1, JON-6, FLT-8
CHANGED_FROM = 1997
CAMPAIGNS_SQL = f"""
SELECT CAST(NULL AS DATE) AS endTime, CAST(o_orderdate AS DATE) AS createTime, CAST(o_orderdate AS DATE) AS startTime,
       o_orderpriority AS name, o_orderkey AS advertId, '9000' AS status, '8000' AS type
FROM orders WHERE year(o_orderdate) >= {CHANGED_FROM}
"""


@register("campaigns_listed", CAMPAIGNS_SQL)
def q_campaigns_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1/2, JOB-2 (PRJ-1, FLT-8, JON-6, SCA-1/6): the campaign list from files, only adverts changed since a year, and the details of
    the listed ones with times in three notations. Stand-in: an order is an advert, the list is grouped by priority in pages."""
    o = table(spark, sf_dir, "orders")
    advert = F.struct(F.col("o_orderkey").alias("advertId"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+03:00'").alias("changeTime"))
    pages = standins.nest_pages(o, ["o_orderpriority"], advert, ["o_orderkey"])
    group = F.struct(F.lit(8000).alias("type"), F.lit("9000").alias("status"), F.size("items").alias("count"), F.col("items").alias("advert_list"))
    tagged = pages.withColumns({"project": F.lit("p"), "day": F.lit("2024-01-02")})
    counts = read_landed(spark, land(tagged, "counts", F.to_json(F.struct(F.array(group).alias("adverts")))), CAMPAIGN_COUNTS, multi_line=False)
    d = F.col("o_orderdate")
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "dd.MM.yyyy HH:mm:ss")).otherwise(F.date_format(d, "yyyy/MM/dd"))
    body = F.to_json(F.struct(F.col("o_orderkey").alias("advertId"), F.col("o_orderpriority").alias("name"), F.lit("9000").alias("status"),
                              F.lit(8000).alias("type"), F.date_format(d, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("createTime"), shown.alias("startTime")))
    details = read_landed(spark, land(o.withColumns({"project": F.lit("p"), "day": F.lit("2024-01-02")}), "details", body), CAMPAIGN_DETAILS, multi_line=False)
    return ads.campaign_dim(details, listed=ads.campaign_list(counts, keep=(), min_year=CHANGED_FROM))


# ------------------------------------------------------------------------------------------ SRC-6, JOB-9, JOB-20
GATED_SQL = f"""
SELECT n_name AS warehouseName, n_nationkey AS quantity, upper(r_name) AS brand, 's' AS subjectName, CAST(NULL AS VARCHAR) AS vendorCode,
       CAST(NULL AS INTEGER) AS inWayToClient, CAST(NULL AS INTEGER) AS inWayFromClient, CAST(NULL AS INTEGER) AS quantityWarehousesFull,
       r_name AS Project, TIMESTAMP '{NOW}' AS Date, 'Wildberries' AS Marketplace
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


@register("stock_load_gated", GATED_SQL)
def q_stock_load_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, JOB-9, JOB-20, SNK-1/11: warehouse remains of several projects from files (several warehouses a product), loaded all or not at all:
    an audit that lacks an expected project, and one with a failed response, load nothing; the complete one loads. Read back."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    shelf = F.struct(F.col("n_name").alias("warehouseName"), F.col("n_nationkey").cast("string").alias("quantity"))
    pages = standins.nest_pages(nation, ["r_name"], shelf, ["n_nationkey"]).withColumns({"project": F.col("r_name"), "day": F.lit("2024-02-01")})
    body = F.to_json(F.struct(F.lower("r_name").alias("brand"), F.lit("s").alias("subjectName"), F.col("items").alias("warehouses")))
    remains = read_landed(spark, land(pages, "remains", body), WAREHOUSE_REMAINS, multi_line=False).withColumnsRenamed({"project": "Project"})
    projects = [r[0] for r in table(spark, sf_dir, "region").select("r_name").collect()]  # the tenants: a handful
    answers = table(spark, sf_dir, "region").select(F.col("r_name").alias("project"), F.lit(200).alias("status_code"), F.lit("ok").alias("text"))
    target = writers.Target(scratch_path(spark, "warehouse-data-wb"), WAREHOUSE_DATA_WB)
    writers.create_table(spark, target)
    failed = answers.withColumn("status_code", F.when(F.col("project") == "ASIA", 429).otherwise(200))
    for responses in (answers.filter("project != 'ASIA'"), failed, answers):
        audit = writers.Target(scratch_path(spark, "load-audit"), LOAD_AUDIT)
        writers.create_table(spark, audit)
        writers.append(spark, load_audit(responses, NOW), audit)
        stock.load_stock_snapshot(spark, remains, writers.read(spark, audit), target, NOW, projects)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------ SRC-7, JOB-11 by project
def _orders_projects_sql() -> str:
    sql = _orders_upsert_sql().replace("TIMESTAMP '2024-02-01T00:00:00' ELSE date_trunc", "date_trunc('second', ts) ELSE date_trunc")
    sql = sql.replace("CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS TINYINT)", "CAST(0 AS TINYINT)")
    sql = sql.replace("CASE WHEN event_type = 'purchase' THEN TIMESTAMP '2024-02-01T00:00:00' ELSE TIMESTAMP '2100-01-01' END", "TIMESTAMP '2100-01-01'")
    return sql.replace("'events' AS Project", "CASE WHEN event_type = 'click' THEN 'old' ELSE 'new' END AS Project").replace(
        "date_trunc('second', ts) AS date,", "date_trunc('second', ts) - CASE WHEN event_type = 'click' THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS date,").replace(
        "CASE WHEN event_type = 'purchase' THEN date_trunc('second', ts) ELSE date_trunc('second', ts) END AS lastChangeDate",
        "date_trunc('second', ts) - CASE WHEN event_type = 'click' THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS lastChangeDate").replace(
        "CAST(ts AS DATE) AS day", "CAST(ts - CASE WHEN event_type = 'click' THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS DATE) AS day")


@register("orders_upsert_projects", _orders_projects_sql())
def q_orders_upsert_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7, JOB-11, FLT-11: order pages of two projects from files, the second project's orders all older than the first's mark; the second
    load runs twice. Each project has its own mark, so nothing is lost and nothing doubles. Read back."""
    ev = table(spark, sf_dir, "events")
    old = F.col("event_type") == "click"
    when = F.date_format(F.col("ts") - F.when(old, F.expr("INTERVAL '400' DAY")).otherwise(F.expr("INTERVAL '0' DAY")), "yyyy-MM-dd'T'HH:mm:ss")
    order = F.struct(when.alias("date"), when.alias("lastChangeDate"), F.col("event_type").alias("warehouseName"), F.col("user_id").alias("nmId"),
                     F.col("value").cast("string").alias("totalPrice"), F.lit(False).alias("isSupply"), F.lit(True).alias("isRealization"),
                     F.lit(False).alias("isCancel"), F.col("event_id").cast("string").alias("srid"))
    rows = ev.select(F.when(old, "old").otherwise("new").alias("project"), F.lit("2024-02-01").alias("day"), order.alias("o"))
    path = land(rows, "orders", F.to_json("o"))
    target = orders_target(scratch_path(spark, "orders-wb"))
    writers.create_table(spark, target)
    pages = read_landed(spark, path, SUPPLIER_ORDERS, multi_line=False)
    for project in ("new", "old", "old"):
        orders_upsert(spark, filters.equals(pages, "project", project).drop("project", "day"), target, project=project)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------ SRC-8, JOB-12 weekly
WEEK_TODAY = "1996-05-15"
_MONDAY = dt.date.fromisoformat(WEEK_TODAY) - dt.timedelta(days=dt.date.fromisoformat(WEEK_TODAY).weekday() + 7)
WEEK_FIRST, WEEK_LAST = _MONDAY, _MONDAY + dt.timedelta(days=6)


def _weekly_sql() -> str:
    mapped = {"realizationreport_id": "l_orderkey", "rrd_id": "CAST(l_linenumber AS BIGINT)", "nm_id": "l_partkey", "quantity": "CAST(trunc(l_quantity) AS BIGINT)",
              "retail_price": "l_extendedprice", "sale_percent": "l_discount", "doc_type_name": "l_returnflag", "rr_dt": "l_shipdate",
              "load_dt": f"TIMESTAMP '{NOW}'", "source": f"'{REALIZATION_SOURCE}'"}
    duck = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    cols = [f"{mapped[c]} AS {c}" if c in mapped else f"CAST(NULL AS {duck[t]}) AS {c}" for c, t in WB_REALIZATION_REPORTS]
    return (f"SELECT {', '.join(cols)} FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{WEEK_FIRST}' AND DATE '{WEEK_LAST}'")


@register("realization_weekly", _weekly_sql())
def q_realization_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8, JOB-12, SCA-22, FLT-9, SNK-1: report rows of several projects in ``project=/day=`` folders; only the previous calendar week's folders are
    read, cleaned and appended to the 75-column ``wb_realization_reports``. Stand-in: a line is a report row, its ship week its folder."""
    li = table(spark, sf_dir, "lineitem")
    body = F.struct(F.col("l_orderkey").cast("string").alias("realizationreport_id"), F.col("l_linenumber").alias("rrd_id"), F.col("l_partkey").alias("nm_id"),
                    F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").cast("string").alias("retail_price"),
                    F.col("l_discount").alias("sale_percent"), F.col("l_returnflag").alias("doc_type_name"), F.lit("").alias("brand_name"),
                    F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("rr_dt"))
    rows = li.withColumns({"project": F.col("l_linestatus"), "day": F.to_date(F.trunc("l_shipdate", "week"))})
    pages = read_landed(spark, land(rows, "realization", F.to_json(body)), REALIZATION_REPORT, multi_line=False)
    week = filters.day_between(pages, "day", WEEK_FIRST, WEEK_LAST).drop("day")
    target = writers.Target(scratch_path(spark, "wb-realization-reports"), WB_REALIZATION_REPORTS)
    writers.create_table(spark, target)
    writers.append(spark, finance.realization_clean(week, NOW, contract=WB_REALIZATION_REPORTS), target)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------ SRC-13, SRC-14, JOB-17, SNK-9
REPORT_SQL = """
SELECT event_type AS campaignId, CAST(ts AS VARCHAR) AS date, CAST(NULL AS DOUBLE) AS dailyBudget, CAST(NULL AS DOUBLE) AS weeklyBudget, value AS spending,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS views, CAST(1 AS DOUBLE) AS clicks, CAST(NULL AS DOUBLE) AS addToCart,
       CAST(NULL AS DOUBLE) AS averageRate, CAST(NULL AS DOUBLE) AS average1000ViewsPrice, CAST(0.5 AS DOUBLE) AS ctr, CAST(NULL AS DOUBLE) AS averageClickPrice,
       CAST(NULL AS DOUBLE) AS ordersCount, CAST(NULL AS DOUBLE) AS ordersSum, CAST(NULL AS DOUBLE) AS drr
FROM events
"""


@register("report_files", REPORT_SQL)
def q_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13/14, JOB-17 at row level, SNK-9: a statistics report that arrives partly as JSON and partly as CSV (other column order, bad numbers),
    typed, exported as CSV and read back."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("campaignId"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"), F.get_json_object("props", "$.k").alias("views"),
        F.lit("1").alias("clicks"), F.col("value").cast("string").alias("spending"), F.lit("0.5").alias("ctr"), F.lit("n/a").alias("drr"), "event_id")
    ev = ev.withColumn("date", F.regexp_replace(F.regexp_replace("date", "0+$", ""), r"\.$", ""))
    path = scratch_path(spark, "report")
    ev.filter("event_id % 2 = 0").drop("event_id").write.json(f"{path}/json")
    ev.filter("event_id % 2 = 1").select("spending", "drr", "ctr", "clicks", "views", "date", "campaignId").write.option("header", True).csv(f"{path}/csv")
    typed = performance.typed_report(read_report_folder(spark, path, multi_line=False))
    out = scratch_path(spark, "report-csv")
    writers.export_csv(typed, out)
    back = spark.read.option("header", True).schema(", ".join(f"{c} {t}" for c, t in typed.dtypes)).csv(out)
    return back.select(*PRODUCT_STATS_COLUMNS)


# ------------------------------------------------------------------------------------------ SRC-10, JOB-14, SNK-10 with the data's own keys
BY_DAY_SQL = """
SELECT p_name AS item_offer_id, CAST(p_partkey AS VARCHAR) AS item_sku, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS extra_fee_amount,
       CAST(p_size AS VARCHAR) AS counts_0, CASE WHEN p_partkey % 3 = 0 THEN '7' END AS counts_1, '2024-3-5' AS date
FROM part
"""


@register("landed_by_day", BY_DAY_SQL)
def q_landed_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, JOB-14 (PRJ-8, FLT-10, SCA-19), SNK-10: realization-by-day pages whose keys are not known beforehand: the schema is read from the files
    (numbers as text), so a key that only some rows have becomes a column too; a failed page is skipped; dumped as JSON lines and read back."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    fee = F.when(key % 2 == 0, F.struct(F.struct(F.col("p_size").alias("amount")).alias("fee")))
    counts = F.when(key % 3 == 0, F.array(F.col("p_size"), F.lit(7))).otherwise(F.array(F.col("p_size")))
    row = F.struct(F.struct(F.col("p_name").alias("offer_id"), key.alias("sku")).alias("item"), fee.alias("extra"), counts.alias("counts"))
    pages = standins.nest_pages(part, ["p_brand"], row, ["p_partkey"]).withColumns({"project": F.lit("p"), "day": F.lit("2024-03-05")})
    path = land(pages, "by-day", F.to_json(F.struct(F.col("items").alias("rows"))))
    land_text(spark, path, "p", "2024-03-05", '{"error": "limit", "message": "try later"}')
    rows = finance.realization_by_day(read_landed(spark, path, None, multi_line=False))
    out = scratch_path(spark, "by-day-dump")
    writers.dump_json(rows, out)
    return spark.read.schema(rows.schema).json(out)


# ------------------------------------------------------------------------------------------ PRJ-8 on arrays in arrays
NESTED_SQL = """
SELECT p_partkey AS id, p_name AS rows_0_name, p_size AS rows_0_vals_0, CAST(p_size + 1 AS INTEGER) AS rows_0_vals_1, p_type AS rows_1_name,
       CAST(2 AS INTEGER) AS rows_1_vals_0, CAST(NULL AS INTEGER) AS rows_1_vals_1, p_retailprice AS m_0_0, CAST(NULL AS DOUBLE) AS m_0_1,
       CAST(1 AS DOUBLE) AS m_1_0, CAST(p_size AS DOUBLE) AS m_1_1
FROM part
"""


@register("recursive_flatten_nested", NESTED_SQL)
def q_recursive_flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8: arrays inside array elements and arrays of arrays, read from JSON text, of unequal sizes: every value has its column."""
    row = lambda name, *vals: F.struct(F.col(name).alias("name"), F.array(*vals).alias("vals"))
    size = F.col("p_size").cast("int")
    body = F.struct(F.col("p_partkey").alias("id"), F.array(row("p_name", size, size + 1), row("p_type", F.lit(2))).alias("rows"),
                    F.array(F.array(F.col("p_retailprice")), F.array(F.lit(1.0), size.cast("double"))).alias("m"))
    docs = parse_json_text(table(spark, sf_dir, "part").select(F.to_json(body).alias("payload")), "payload",
                           "id bigint, rows array<struct<name:string, vals:array<int>>>, m array<array<double>>")
    return recursive_flatten(docs, {"rows_vals": 1})


# ------------------------------------------------------------------------------------------ small operators
SMALL_SQL = """
SELECT o_orderkey, o_orderdate AS changed, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price,
       COALESCE(CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END, 'none') AS priority
FROM orders WHERE o_custkey % 5 <> 0
"""


@register("valid_rows", SMALL_SQL)
def q_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6, SCA-12, SCA-25: rows whose time text parses; NaN as null; a default for a missing value."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_custkey") % 5 == 0, F.lit("not a time")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = o.select("o_orderkey", text.alias("changed"), F.when(F.col("o_custkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("raw"),
                    F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")).alias("p"))
    return filters.valid_timestamps(rows, "changed").select("o_orderkey", "changed", nan_to_null("raw").alias("price"), with_default("p", "none").alias("priority"))


SETS_SQL = """
SELECT DISTINCT * FROM (SELECT n_nationkey AS key, n_name AS name, CAST(NULL AS VARCHAR) AS segment FROM nation
                        UNION ALL SELECT c_nationkey, NULL, c_mktsegment FROM customer) u
"""


@register("distinct_union", SETS_SQL)
def q_distinct_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-2, AGG-5: frames with different columns unioned by name, then the distinct rows."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return distinct_values(setops.union_by_name([n, c]), ["key", "name", "segment"])


HEAD_SQL = "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5"


@register("sorted_head", HEAD_SQL)
def q_sorted_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1, SRT-4: the first rows of a sorted frame, for display (the limit is the feature)."""
    return sort.head(sort.sort_desc(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"]), 5)


ROW_TEXT_SQL = """
SELECT o_orderkey, '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '","o_clerk":null}' AS metadata_json
FROM orders
"""


@register("row_json_dump", ROW_TEXT_SQL)
def q_row_json_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-2, UDF-3, SNK-5, SNK-10: rows with a timestamp and a null serialised to JSON text, dumped as JSON lines and read back; the table written first
    is truncated before the load, so only the dump's rows are left."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.lit(None).cast("string").alias("o_clerk"))
    path = scratch_path(spark, "dump")
    writers.dump_json(row_to_json(o).select("o_orderkey", "metadata_json"), path)
    target = writers.Target(scratch_path(spark, "row-json"), [("o_orderkey", "bigint"), ("metadata_json", "string")])
    writers.create_table(spark, target)
    back = spark.read.schema(target.schema).json(path)
    writers.append(spark, back, target)
    writers.truncate(spark, target)
    writers.append(spark, back, target)
    return writers.read(spark, target)

"""Registered queries of the checks on what was landed: page sequences, cursor chains, counted casts, coverage, and the operators that
compare whole periods or all groupings at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import parse_timestamp_formats, to_double, to_long
from ..functions.labels import MARKETPLACE_WB
from ..operators import casts, coverage, pages
from ..operators.aggregate import regroup_switches
from ..operators.flatten import variant_leaves
from ..operators.window import rolling_periods, selected_and_previous
from ..schemas import FUNNEL_PAGE, ORDER_HISTORY_WB
from ..session import scratch_path
from ..sinks import writers
from ..sources.landed import read_landed
from ..sources.tables import table
from . import ads, funnel, standins
from .catalog import register
from .queries_ads import AD_ORDERS_FACT_SQL, daily_fact, campaign_details, facts_with_campaign, product_day_orders
from .standins import land

# ------------------------------------------------------------------------------------------------ SRC-5, SET-3
LAST_PAGE = 9
# A brand's pages are its parts' sizes mod 9. Of brands with an odd first digit some pages are lost, some come twice, some say too early that they are
# the last, and some last pages are lost, so that the highest one left says that another follows.
_PAGES_SQL = f"""
SELECT project, DATE '2024-01-02' AS day, page, CASE WHEN odd AND (b + page) % 13 = 0 THEN FALSE ELSE page < {LAST_PAGE} END AS more,
       CASE WHEN odd AND (b + page) % 11 = 0 THEN 2 ELSE 1 END AS copies, nm
FROM (SELECT p_brand AS project, ascii(substr(p_brand, 7, 1)) % 2 = 1 AS odd, ascii(substr(p_brand, 8, 1)) AS b, p_size % {LAST_PAGE} + 1 AS page,
             MIN(p_partkey) AS nm FROM part GROUP BY ALL) p
WHERE NOT (odd AND (b + page) % 7 = 0)
"""
PAGE_PROBLEMS_SQL = f"""
WITH p AS ({_PAGES_SQL}),
     n AS (SELECT *, lag(page, 1, 0) OVER w AS before, lead(page) OVER w AS after FROM p WINDOW w AS (PARTITION BY project, day ORDER BY page))
SELECT project, day, '{pages.MISSING}' AS problem, CAST(before + 1 AS BIGINT) AS first_page, CAST(page - 1 AS BIGINT) AS last_page FROM n WHERE page > before + 1
UNION ALL SELECT project, day, '{pages.NO_LAST}', page + 1, NULL FROM n WHERE after IS NULL AND more
UNION ALL SELECT project, day, '{pages.DOUBLE}', page, page FROM n WHERE copies = 2
UNION ALL SELECT project, day, '{pages.EARLY_END}', page, page FROM n WHERE after IS NOT NULL AND NOT more
"""


def numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed funnel pages of several projects with the faults of ``_PAGES_SQL``."""
    parts = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("project"), (F.col("p_size") % LAST_PAGE + 1).alias("page")).agg(F.min("p_partkey").alias("nm"))
    at, odd = F.ascii(F.substring("project", 8, 1)) + F.col("page"), F.ascii(F.substring("project", 7, 1)) % 2 == 1
    found = parts.filter(~(odd & (at % 7 == 0))).withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(odd & (at % 11 == 0), 2).otherwise(1))))
    more = F.when(odd & (at % 13 == 0), F.lit(False)).otherwise(F.col("page") < LAST_PAGE)
    card = F.struct(F.col("nm").alias("nmID"), F.struct(F.struct(F.lit("2024-01-02").alias("begin"), F.lit(1).alias("ordersCount")).alias("selectedPeriod")).alias("statistics"))
    body = F.to_json(F.struct(F.struct("page", more.alias("isNextPage"), F.array(card).alias("cards")).alias("data")))
    path = land(found.withColumn("day", F.lit("2024-01-02")), "numbered-pages", body)
    return read_landed(spark, path, FUNNEL_PAGE, multi_line=False)


def sequence_of(landed: DataFrame) -> DataFrame:
    return landed.select("project", "day", to_long("data.page").alias("page"), F.col("data.isNextPage").alias("isNextPage"))


@register("page_problems", PAGE_PROBLEMS_SQL)
def q_page_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5, SET-3: missing pages, missing last pages, double pages and pages after the last in the landed funnel pages of several projects."""
    return pages.page_problems(sequence_of(numbered_pages(spark, sf_dir)))


GATED_FUNNEL_SQL = f"""
WITH bad AS (SELECT DISTINCT project FROM ({PAGE_PROBLEMS_SQL}) x)
SELECT CAST(nm AS BIGINT) AS nmID, project AS "Project" FROM ({_PAGES_SQL}) p WHERE project NOT IN (SELECT project FROM bad)
"""


@register("funnel_load_gated", GATED_FUNNEL_SQL)
def q_funnel_load_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-8, JOB-20, SRC-5: only the project-days whose page sequence is complete are flattened and appended to ``order_history_wb``; read back."""
    landed = numbered_pages(spark, sf_dir)
    complete = pages.complete_groups(landed, pages.page_problems(sequence_of(landed)))
    target = writers.Target(scratch_path(spark, "funnel-gated"), ORDER_HISTORY_WB)
    writers.create_table(spark, target)
    tagged = complete.withColumnsRenamed({"project": "Project"}).withColumn("Marketplace", F.lit(MARKETPLACE_WB))
    writers.append(spark, funnel.funnel_daily(tagged), target)
    return writers.read(spark, target).select("nmID", "Project")


# ------------------------------------------------------------------------------------------------ SRC-7, SRC-8
PAGE_IDS = 100
# Pages of 100 ids; the projects take turns of three pages, every seventh page is lost, every fifth begins with the ten ids before it.
_CURSOR_SQL = f"""
SELECT 'p' || (no // 3) % 3 AS project, lo - CASE WHEN no % 5 = 0 THEN 10 ELSE 0 END AS lo, hi
FROM (SELECT event_id // {PAGE_IDS} AS no, MIN(event_id) AS lo, MAX(event_id) AS hi FROM events GROUP BY event_id // {PAGE_IDS}) p WHERE no % 7 <> 3
"""
CURSOR_SQL = f"""
WITH s AS (SELECT project, lo, hi, MAX(hi) OVER (PARTITION BY project ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
           FROM ({_CURSOR_SQL}) c)
SELECT project, '{pages.OVERLAP}' AS problem, lo AS from_id, least(hi, top) AS to_id FROM s WHERE lo <= top
UNION ALL SELECT project, '{pages.HOLE}', top + 1, lo - 1 FROM s WHERE lo > top + 1
"""


@register("cursor_problems", CURSOR_SQL)
def q_cursor_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7, SRC-8: report pages of three projects that each continue after the last ``rrd_id``, landed as arrays; ids sent twice and ids never sent."""
    no = F.floor(F.col("event_id") / PAGE_IDS)
    ids = table(spark, sf_dir, "events").select("event_id", no.alias("no")).filter("no % 7 <> 3")
    again = ids.filter(f"no % 5 = 0 and event_id % {PAGE_IDS} < 10").select((F.col("event_id") - 10).alias("event_id"), "no")
    rows = ids.unionByName(again).groupBy("no").agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("rrd_id")))).alias("rows"))
    rows = rows.select(F.concat(F.lit("p"), (F.floor(F.col("no") / 3) % 3).cast("string")).alias("project"), F.lit("2024-02-01").alias("day"),
                       F.to_json(F.struct("rows")).alias("page"))
    path = land(rows, "cursor-pages", F.col("page"))
    landed = read_landed(spark, path, "rows array<struct<rrd_id:string>>", multi_line=False)
    rrd = F.transform("rows", lambda r: to_long(r["rrd_id"]))
    return pages.cursor_problems(landed.select("project", F.array_min(rrd).alias("first_id"), F.array_max(rrd).alias("last_id")))


# ------------------------------------------------------------------------------------------------ SCA-6, FLT-6
CAST_FORMATS = ["dd.MM.yyyy HH:mm:ss"]
CAST_COUNTS_SQL = """
SELECT "column", CAST("read" AS BIGINT) AS "read", CAST("null" AS BIGINT) AS "null", CAST(failed AS BIGINT) AS failed FROM (
  SELECT 'changed' AS "column", COUNT(*) AS "read", COUNT(*) FILTER (o_custkey % 11 = 0) AS "null", COUNT(*) FILTER (o_custkey % 11 <> 0 AND o_custkey % 5 = 0) AS failed FROM orders
  UNION ALL SELECT 'price', COUNT(*), 0, COUNT(*) FILTER (o_orderkey % 7 = 0) FROM orders
  UNION ALL SELECT 'amount', COUNT(*), COUNT(*) FILTER (o_orderkey % 3 = 0), 0 FROM orders) c
"""


@register("cast_counts", CAST_COUNTS_SQL)
def q_cast_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCA-6, FLT-6: values read, null and not castable of each column of an order report, counted in the pass that writes it; a load whose
    limit is stricter than the report stops before the table changes."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_custkey") % 11 == 0, F.lit(None)).when(F.col("o_custkey") % 5 == 0, F.lit("not a time")).when(
        F.col("o_custkey") % 2 == 0, F.date_format("o_orderdate", CAST_FORMATS[0])).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+03:00'"))
    report = o.select("o_orderkey", text.alias("changed"), F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
                      F.when(F.col("o_orderkey") % 3 != 0, F.col("o_shippriority").cast("string") if "o_shippriority" in o.columns else F.lit("1")).alias("amount"))
    target = writers.Target(scratch_path(spark, "checked"), [("o_orderkey", "bigint"), ("changed", "timestamp_ntz"), ("price", "double"), ("amount", "bigint")])
    writers.create_table(spark, target)
    how = {"changed": parse_timestamp_formats("changed", CAST_FORMATS), "price": to_double("price"), "amount": to_long("amount")}
    try:
        casts.append_checked(spark, report, how, target, most_failed=0.01)
        raise AssertionError("a load with bad values went through")
    except casts.TooManyBadValues:
        if not writers.read(spark, target).isEmpty():
            raise
    counts = casts.append_checked(spark, report, how, target, most_failed=0.5)
    return spark.createDataFrame(counts, "column string, read long, null long, failed long")


# ------------------------------------------------------------------------------------------------ JON-2, SCA-13
LOADED_WINDOWS = [("events", "2024-01-08", "2024-01-15"), ("events", "2024-01-14", "2024-01-20"), ("events", "2024-01-21", "2024-01-22"),
                  ("events", "2024-01-29", "2024-02-03"), ("other", "2024-01-01", "2024-01-31")]
_IN_WINDOW = "(CAST({day} AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-22' OR CAST({day} AS DATE) >= DATE '2024-01-29')"


def _covered_sql() -> str:
    metrics = ("ordersCount", "ordersSumRub", "addToCartCount")
    cols = ", ".join(f"CASE WHEN {_IN_WINDOW.format(day='day')} THEN {m} END AS {m}" for m in metrics)
    return f"SELECT * EXCLUDE ({', '.join(metrics)}), {cols} FROM ({AD_ORDERS_FACT_SQL}) f"


@register("ad_orders_covered", _covered_sql())
def q_ad_orders_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-2, SCA-13: ads of a whole month, orders landed for some windows of it (overlapping, adjoining, and one apart): 0 orders on a landed day
    without any, null on a day that was not landed."""
    windows = spark.createDataFrame(LOADED_WINDOWS, "Project string, first_day string, last_day string")
    orders = product_day_orders(spark, sf_dir).filter(_IN_WINDOW.format(day="day"))
    return ads.ad_orders_fact(facts_with_campaign(spark, sf_dir), orders, coverage=coverage.merged_intervals(windows))


@register("ad_orders_orders_first", AD_ORDERS_FACT_SQL)
def q_ad_orders_orders_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-5: orders joined before campaigns; the same rows as ``ad_orders_fact``."""
    return ads.ad_orders_fact_orders_first(daily_fact(spark, sf_dir), ads.campaign_dim(campaign_details(spark)), product_day_orders(spark, sf_dir))


@register("ad_orders_fact_cards", AD_ORDERS_FACT_SQL)
def q_ad_orders_fact_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-4 in full (SRC-5, PRJ-5, JON-2, JON-4, SCA-13): product-day orders from landed funnel cards, attached to the ads with their campaigns, in
    the 22-column contract. Stand-in: a user's day with purchases is a card."""
    days = standins.product_day_history_rows(table(spark, sf_dir, "events"))
    period = F.struct(F.col("dt").alias("begin"), "ordersCount", F.col("ordersSumRub").cast("string").alias("ordersSumRub"), "addToCartCount")
    card = F.struct("nmID", F.struct(period.alias("selectedPeriod")).alias("statistics"))
    found = standins.nest_pages(days, ["dt"], card, ["nmID"]).select(F.lit("events").alias("project"), F.col("dt").alias("day"), "items")
    body = F.to_json(F.struct(F.struct(F.col("items").alias("cards")).alias("data")))
    cards = read_landed(spark, land(found, "card-days", body), FUNNEL_PAGE, multi_line=False)
    return ads.ad_orders_fact(facts_with_campaign(spark, sf_dir), ads.product_day_orders_from_cards(ads.flatten_funnel_cards(cards)))


# ------------------------------------------------------------------------------------------------ PRJ-8 as rows
VARIANT_SQL = """
SELECT p_partkey AS id, unnest([{'path': 'item_offer_id', 'value': p_name}, {'path': 'item_sku', 'value': CAST(p_partkey AS VARCHAR)},
         {'path': 'sizes_0', 'value': CAST(p_size AS VARCHAR)}, {'path': 'sizes_1_inner_0', 'value': '7'}, {'path': 'k' || CAST(p_size AS VARCHAR), 'value': p_type},
         {'path': 'flag', 'value': CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END}, {'path': 'none', 'value': NULL}], recursive := true)
FROM part
"""


@register("variant_paths", VARIANT_SQL)
def q_variant_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8 in long form (JOB-14 for wide documents): path and value of every leaf of JSON texts whose keys differ from row to row, without a schema."""
    item = F.struct(F.col("p_name").alias("offer_id"), F.col("p_partkey").alias("sku"), F.create_map().alias("nothing"))
    body = F.struct(item.alias("item"), F.array().alias("empty"), F.array(F.col("p_size").cast("string"), F.lit("@")).alias("sizes"), (F.col("p_size") > 25).alias("flag"),
                    F.lit(None).cast("string").alias("none"))
    text = F.to_json(body, {"ignoreNullFields": "false"})
    own = F.to_json(F.create_map(F.concat(F.lit("k"), F.col("p_size").cast("string")), F.col("p_type")))
    text = F.replace(F.concat(F.regexp_replace(text, r"\}$", ","), F.substring(own, 2, 1_000_000)), F.lit('"@"'), F.lit('{"inner":[7]}'))
    return variant_leaves(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.alias("payload")), "payload", keep=["id"])


# ------------------------------------------------------------------------------------------------ WIN-2
N_DAYS = 30
ROLLING_SQL = f"""
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY ALL),
s AS (SELECT o_custkey, day,
        CAST(SUM(v) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL {N_DAYS - 1} DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS selected,
        CAST(SUM(v) OVER (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN INTERVAL {2 * N_DAYS - 1} DAY PRECEDING AND INTERVAL {N_DAYS} DAY PRECEDING) AS DOUBLE) AS previous
      FROM d)
SELECT o_custkey, day, selected, previous, ROUND(CASE WHEN previous <> 0 THEN selected / previous - 1 END, 6) AS change FROM s
"""


@register("rolling_periods", ROLLING_SQL)
def q_rolling_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-2: for each product (customer) and day, the last 30 days against the 30 before, by ranges of days."""
    return rolling_periods(table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate")), ["o_custkey"], "day", "o_totalprice", N_DAYS)


SELECTED = ("1997-03-10", "1997-05-04")
SELECTED_SQL = f"""
SELECT o_custkey, selected, previous, ROUND(CASE WHEN previous <> 0 THEN selected / previous - 1 END, 6) AS change FROM (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (CAST(o_orderdate AS DATE) >= DATE '{SELECTED[0]}') AS DOUBLE) AS selected,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (CAST(o_orderdate AS DATE) < DATE '{SELECTED[0]}') AS DOUBLE) AS previous
  FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{SELECTED[0]}' - CAST(DATE '{SELECTED[1]}' - DATE '{SELECTED[0]}' + 1 AS INTEGER) AND DATE '{SELECTED[1]}'
  GROUP BY o_custkey) x
"""


@register("selected_period", SELECTED_SQL)
def q_selected_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-2: a selected period against the one of equal length before it, as the funnel report defines it."""
    return selected_and_previous(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_totalprice", *SELECTED)


# ------------------------------------------------------------------------------------------------ AGG-9
SWITCHES_SQL = """
SELECT grouping(p_brand) = 0 AS "groupByBrand", grouping(p_type) = 0 AS "groupBySubject", grouping(p_container) = 0 AS "groupBySa", p_brand, p_type, p_container,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CAST(SUM(CAST(l_extendedprice AS DECIMAL(38,10))) AS DOUBLE) AS total
FROM lineitem JOIN (SELECT p_partkey, p_brand, p_type, 'c' || CAST(p_size % 4 AS VARCHAR) AS p_container FROM part) p ON l_partkey = p_partkey
GROUP BY CUBE (p_brand, p_type, p_container)
"""


@register("stock_switches", SWITCHES_SQL)
def q_stock_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-9: stock regrouped by every subset of the three switches in one scan and shuffle."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.concat(F.lit("c"), (F.col("p_size") % 4).cast("string")).alias("p_container"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("total"))
    return regroup_switches(rows.join(part, rows["l_partkey"] == part["p_partkey"]),
                            {"groupByBrand": "p_brand", "groupBySubject": "p_type", "groupBySa": "p_container"}, counts=["quantity"], money=["total"])

"""Registered sink queries (FIXTURES B32-B34, JOB-7, JOB-11): each writes real tables under the shared folder
(``spark.checkpoint.dir``), runs the sink operator, and returns the table read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import reload_days
from ..operators.filters import after_high_water_mark
from ..session import scratch_path
from ..sinks import writers
from ..sources.tables import table
from . import ads, standins
from .catalog import register
from .orders import ORDERS_WB_TABLE, orders_target, orders_upsert
from .queries_ads import AD_ORDERS_FACT_SQL, campaign_details, product_day_orders
from ..schemas import CAMPAIGN_DATA_WB
from .queries_core import LATEST_SQL, LINE_COLUMNS


def _new_table(spark: SparkSession, stem: str, contract, partition_by=()) -> writers.Target:
    target = writers.Target(scratch_path(spark, stem), contract, tuple(partition_by))
    writers.create_table(spark, target)
    return target


# --------------------------------------------------------------------------------------------- B32
BACKFILL_LAST_DAY = "1997-12-31"
# The target's column order differs from the source's on purpose: the copy must bind by name.
BACKFILL_CONTRACT = [("o_orderkey", "bigint"), ("addToCartCount", "int"), ("o_orderstatus", "string"),
                     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz")]
BACKFILL_SQL = f"""
SELECT o_orderkey, CAST(0 AS INTEGER) AS addToCartCount, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderdate <= TIMESTAMP '{BACKFILL_LAST_DAY} 23:59:59'
"""


@register("backfill_with_default", BACKFILL_SQL)
def q_backfill_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B32 (SNK-4, FLT-7, SNK-6): copy rows up to the end of a day into a new table with a constant 0 column,
    columns bound by name; read back."""
    target = _new_table(spark, "backfill", BACKFILL_CONTRACT)
    src = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_orderstatus", "o_orderkey")
    writers.backfill_with_default(spark, src, target, "o_orderdate", BACKFILL_LAST_DAY, {"addToCartCount": 0})
    return writers.read(spark, target)


# --------------------------------------------------------------------------------------------- B33
RELOAD_TODAY, RELOAD_DAYS = "1998-03-10", 6
RELOAD_FIRST, RELOAD_LAST = reload_days(RELOAD_TODAY, RELOAD_DAYS)
RELOAD_CONTRACT = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("batch", "string"), ("day", "date")]
RELOAD_SQL = f"""
SELECT o_orderkey, o_totalprice, 'base' AS batch, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '{RELOAD_FIRST}' AND DATE '{RELOAD_LAST}'
UNION ALL
SELECT o_orderkey, o_totalprice, 'reload' AS batch, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{RELOAD_FIRST}' AND DATE '{RELOAD_LAST}' - 1
"""


@register("reload_window", RELOAD_SQL)
def q_reload_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B33 (SNK-2, SCA-23, SNK-1): a day-partitioned table loaded with every order, then the 6 days ending
    yesterday reloaded from a re-fetch. The re-fetch has no rows for the last window day, which therefore
    ends empty (delete-then-insert semantics); days outside the window are untouched. Read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    target = _new_table(spark, "reload", RELOAD_CONTRACT, ["day"])
    writers.append(spark, orders.withColumn("batch", F.lit("base")), target)
    refetch = orders.filter(F.col("day").between(F.lit(str(RELOAD_FIRST)).cast("date"),
                                                 F.date_sub(F.lit(str(RELOAD_LAST)).cast("date"), 1)))
    writers.reload_window(spark, refetch.withColumn("batch", F.lit("reload")), target, RELOAD_FIRST, RELOAD_LAST)
    return writers.read(spark, target)


# --------------------------------------------------------------------------------------------- B34
UPSERT_CUTOFF = "1998-06-01"
ORDERS_A_BUCKET = 20_000
LINE_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
              "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
              "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
UPSERT_CONTRACT = [(c, LINE_TYPES[c]) for c in LINE_COLUMNS] + [("bucket", "int")]


@register("upsert_orders", LATEST_SQL)
def q_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B34 (SNK-3, FLT-11, WIN-1): two batches split by ship date upserted into a table partitioned by ranges of the
    order key (every version of a key shares a partition, the number of partitions grows with the table, and a batch touches only its
    own orders' ranges); the second batch is taken from the table's high-water mark on. Latest version per key wins: the result equals ``latest_version``."""
    li = (table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
          .withColumn("bucket", F.floor(F.col("l_orderkey") / ORDERS_A_BUCKET).cast("int")))
    target = _new_table(spark, "upsert", UPSERT_CONTRACT, ["bucket"])
    key = ["l_orderkey", "l_linenumber"]
    cutoff = F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    writers.upsert_latest(spark, li.filter(F.col("l_shipdate") < cutoff), target, key, "l_shipdate")
    hwm = writers.read(spark, target).agg(F.max("l_shipdate")).first()[0]
    second = after_high_water_mark(li.filter(F.col("l_shipdate") >= cutoff), "l_shipdate", hwm)
    writers.upsert_latest(spark, second, target, key, "l_shipdate")
    return writers.read(spark, target).drop("bucket")


# -------------------------------------------------------------------------------------------- JOB-7
AD_TODAY, AD_DAYS = "2024-01-31", 6
AD_FIRST, AD_LAST = reload_days(AD_TODAY, AD_DAYS)
# The 22-column contract partitioned by day; the stand-in's campaign ids are event types, hence text.
AD_TABLE = [*[(c, "string" if c == "advertId" else t) for c, t in CAMPAIGN_DATA_WB if c != "day"], ("day", "date")]


def _reload_ad_sql() -> str:
    cols = []
    for c, _ in AD_TABLE:
        if c == "day":
            cols.append("CAST(day AS DATE) AS day")
        elif c in ("ordersCount", "ordersSumRub", "addToCartCount"):
            cols.append(f"CASE WHEN CAST(day AS DATE) BETWEEN DATE '{AD_FIRST}' AND DATE '{AD_LAST}' THEN {c} "
                        f"ELSE 0 END AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM ({AD_ORDERS_FACT_SQL}) f"


@register("reload_ad_window", _reload_ad_sql())
def q_reload_ad_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-7 (SNK-1, SNK-2, SCA-23, JON-1/2): the daily ad fact is first loaded before any orders are known
    (0 orders on every day), then the 6 days ending yesterday are recomputed with product-day orders and
    replaced in the day-partitioned table. Days outside the window keep 0 orders. Read back."""
    events = table(spark, sf_dir, "events")
    flat = standins.ad_stats_rows(events)
    dim = ads.campaign_dim(campaign_details(spark))
    orders = product_day_orders(spark, sf_dir)
    target = _new_table(spark, "campaign_data_wb", AD_TABLE, ["day"])
    facts = ads.ad_facts_with_campaign(ads.ad_daily_fact(flat, order_cols=("date",)), dim)
    no_orders_yet = orders.filter(F.lit(False))
    writers.append(spark, ads.ad_orders_fact(facts, no_orders_yet).withColumn("day", F.to_date("day")), target)
    ads.reload_ad_window(spark, flat, dim, orders, target, AD_TODAY, AD_DAYS)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------- JOB-11
ORDERS_CHANGED_AT = "2024-02-01T00:00:00"


def _orders_upsert_sql() -> str:
    duck = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "tinyint": "TINYINT",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    cancelled = "event_type = 'purchase'"
    mapped = {
        "date": "date_trunc('second', ts)",
        "lastChangeDate": f"CASE WHEN {cancelled} THEN TIMESTAMP '{ORDERS_CHANGED_AT}' ELSE date_trunc('second', ts) END",
        "warehouseName": "event_type", "nmId": "user_id", "totalPrice": "value",
        "isSupply": "CAST(0 AS TINYINT)", "isRealization": "CAST(1 AS TINYINT)",
        "isCancel": f"CAST(CASE WHEN {cancelled} THEN 1 ELSE 0 END AS TINYINT)",
        "cancelDate": f"CASE WHEN {cancelled} THEN TIMESTAMP '{ORDERS_CHANGED_AT}' ELSE TIMESTAMP '2100-01-01' END",
        "srid": "CAST(event_id AS VARCHAR)", "Marketplace": "'Wildberries'", "Project": "'events'",
        "day": "CAST(ts AS DATE)",
    }
    cols = [f"{mapped[c]} AS {c}" if c in mapped else f"CAST(NULL AS {duck[t]}) AS {c}" for c, t in ORDERS_WB_TABLE]
    return "SELECT " + ", ".join(cols) + " FROM events"


@register("orders_upsert", _orders_upsert_sql())
def q_orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-11 (SCA-5, SCA-10, SCA-16, FLT-11, WIN-1, SNK-3): two landed batches of the supplier order log
    upserted into a day-partitioned table. Batch 1: every event as an order (no cancel date -> sentinel);
    batch 2, taken from the table's high-water mark on: the purchases sent again as cancelled at a later
    change time, which must replace their first version. Read back."""
    ev = table(spark, sf_dir, "events")
    text_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")

    def landed(cancelled: bool) -> DataFrame:
        rows = ev.filter(F.col("event_type") == "purchase") if cancelled else ev
        changed = F.lit(ORDERS_CHANGED_AT) if cancelled else text_ts
        return rows.select(
            text_ts.alias("date"), changed.alias("lastChangeDate"), F.col("event_type").alias("warehouseName"),
            F.col("user_id").alias("nmId"), F.col("value").alias("totalPrice"), F.lit(False).alias("isSupply"),
            F.lit(True).alias("isRealization"), F.lit(cancelled).alias("isCancel"),
            (F.lit(ORDERS_CHANGED_AT) if cancelled else F.lit(None).cast("string")).alias("cancelDate"),
            F.col("event_id").cast("string").alias("srid"))

    target = orders_target(scratch_path(spark, "orders_wb"))
    writers.create_table(spark, target)
    orders_upsert(spark, landed(False), target, project="events")
    orders_upsert(spark, landed(True), target, project="events")
    return writers.read(spark, target)

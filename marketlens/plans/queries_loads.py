"""Registered queries of loads that may run again or that keep everything: the ledger of loads, ERP stock, finance operations with all items, and the
history that is read again before it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import setops
from ..schemas import ERP_STOCK, FINANCE_OPERATIONS, OZON_FINANCE, STOCKS
from ..session import scratch_path
from ..sinks import writers
from ..sources.landed import read_history, read_landed
from ..sources.tables import table
from . import finance, standins, stock
from .catalog import register
from .standins import land

NOW = "2024-02-01 06:00:00"

# ------------------------------------------------------------------------------------------------ SNK-1, run again
DAILY_CONTRACT = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("Project", "string"), ("day", "date")]
APPEND_ONCE_SQL = """
SELECT o_orderkey, o_totalprice, o_orderstatus AS "Project", CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders WHERE o_orderstatus = 'P'
"""


@register("append_once", APPEND_ONCE_SQL)
def q_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: a load that is sent twice is there once, also when its first run ended before the last units were entered in the ledger; another load
    with the same rows of one project adds them. Read back."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("Project"), F.to_date(F.trunc("o_orderdate", "month")).alias("day"))
    target = writers.once_target(scratch_path(spark, "append-once"), DAILY_CONTRACT, ["Project", "day"])
    # A run that came as far as one project: its folders are written and in the ledger.
    writers.append_once(spark, rows.filter("Project = 'F'"), target, "load-1", NOW)
    for _ in range(2):
        writers.append_once(spark, rows, target, "load-1", NOW)
    writers.append_once(spark, rows.filter("Project = 'P'"), target, "load-2", NOW)
    return writers.read_loaded(spark, target)


# ------------------------------------------------------------------------------------------------ PRJ-9, JOB-13
def _operations_sql(first_only: bool) -> str:
    duck = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    own = {"project": "'p'", "operation_id": "o_orderkey", "operation_type": "o_orderstatus", "operation_date": "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)",
           "delivery_charge": "CAST(0 AS DOUBLE)", "return_delivery_charge": "CAST(0 AS DOUBLE)", "accruals_for_sale": "CAST(0 AS DOUBLE)",
           "sale_commission": "CAST(0 AS DOUBLE)", "amount": "CASE WHEN place = 0 THEN o_totalprice ELSE CAST(0 AS DOUBLE) END",
           "item_name": "CASE WHEN place < items THEN o_orderpriority || place END", "item_sku": "CASE WHEN place < items THEN o_custkey + place ELSE 0 END",
           "service_name": "CASE WHEN place < services THEN 'service ' || place END",
           "service_price": "CASE WHEN place < services THEN CAST(place + 1 AS DOUBLE) / 4 END"}
    cols = ", ".join(f"{own[c]} AS {c}" if c in own else f"CAST(NULL AS {duck[t]}) AS {c}" for c, t in OZON_FINANCE)
    return f"""
SELECT {cols} FROM (
  SELECT *, unnest(range({'1' if first_only else 'greatest(items, services, 1)'})) AS place
  FROM (SELECT *, o_orderkey % 4 AS items, o_custkey % 3 AS services FROM orders) o) x
"""


def landed_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operation pages from files; an operation has 0 to 3 items and 0 to 2 services."""
    places = lambda n, body: F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < n), body)
    items = places(F.col("o_orderkey") % 4, lambda i: F.struct(F.concat(F.col("o_orderpriority"), i.cast("string")).alias("name"), (F.col("o_custkey") + i).cast("string").alias("sku")))
    services = places(F.col("o_custkey") % 3, lambda i: F.struct(F.concat(F.lit("service "), i.cast("string")).alias("name"), ((i + 1) / 4).alias("price")))
    operation = F.struct(F.col("o_orderkey").cast("string").alias("operation_id"), F.col("o_orderstatus").alias("operation_type"),
                         F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00").alias("operation_date"), F.col("o_totalprice").cast("string").alias("amount"),
                         items.alias("items"), services.alias("services"))
    found = standins.nest_pages(table(spark, sf_dir, "orders"), ["o_orderpriority"], operation, ["o_orderkey"])
    tagged = found.withColumns({"project": F.lit("p"), "day": F.lit("2024-02-01")})
    path = land(tagged, "operations", F.to_json(F.struct(F.struct(F.col("items").alias("operations")).alias("result"))))
    return read_landed(spark, path, FINANCE_OPERATIONS, multi_line=False)


@register("operations_all_items", _operations_sql(False))
def q_operations_all_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-9, JOB-13 without loss: every item and service of the landed operations, side by side; the amounts add up to the payload's."""
    return finance.finance_operations(landed_operations(spark, sf_dir), all_items=True)


@register("ozon_finance_loaded", _operations_sql(True))
def q_ozon_finance_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-13, SRC-9, SNK-1: the landed operations with their first item and service, appended to ``ozon_finance``; read back."""
    target = writers.Target(scratch_path(spark, "ozon-finance"), OZON_FINANCE)
    writers.create_table(spark, target)
    writers.append(spark, finance.finance_operations(landed_operations(spark, sf_dir)), target)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------------ JOB-10
def _stocks_sql() -> str:
    own = {"moment": f"TIMESTAMP '{NOW}'", "assortment_type": "'product'", "assortment_code": "CAST(p_partkey AS VARCHAR)", "assortment_name": "p_name", "assortment_brand": "p_brand",
           "assortment_volume": "CAST(p_size AS DOUBLE)", "stock_stock": "CAST(p_size AS DOUBLE)", "stock_cost": "p_retailprice"}
    duck = {"double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    return "SELECT " + ", ".join(f"{own[c]} AS {c}" if c in own else f"CAST(NULL AS {duck[t]}) AS {c}" for c, t in STOCKS if c != "metadata_json") + """,
       '{"moment":"' || '""" + NOW + """' || '","assortment.type":"product","assortment.code":"' || CAST(p_partkey AS VARCHAR) || '","assortment.name":"' || p_name ||
       '","assortment.gtin":null,"assortment.brand":"' || p_brand || '","assortment.state":null,"assortment.folder":null,"assortment.volume":"' || CAST(p_size AS VARCHAR) ||
       '","stock.stock":"' || CAST(p_size AS VARCHAR) || '","stock.transit":null,"stock.reserve":null,"stock.quantity":null,"stock.days":null,"stock.cost":"' ||
       CAST(p_retailprice AS VARCHAR) || '"}' AS metadata_json FROM part"""


@register("erp_stock_loaded", _stocks_sql())
def q_erp_stock_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-10, SRC-16, PRJ-7, PRJ-19, SNK-1: ERP stock pages from files, flattened with the whole item as JSON, appended to ``stocks``; read back."""
    item = F.struct(F.lit(NOW).alias("moment"),
                    F.struct(F.lit("product").alias("type"), F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
                             F.col("p_size").alias("volume")).alias("assortment"),
                    F.struct(F.col("p_size").alias("stock"), F.col("p_retailprice").cast("string").alias("cost")).alias("stock"))
    found = standins.nest_pages(table(spark, sf_dir, "part"), ["p_brand"], item, ["p_partkey"])
    path = land(found.withColumns({"project": F.lit("p"), "day": F.lit("2024-02-01")}), "erp-stock", F.to_json(F.struct(F.col("items").alias("stocks"))))
    target = writers.Target(scratch_path(spark, "stocks"), STOCKS)
    writers.create_table(spark, target)
    writers.append(spark, stock.erp_stock_snapshot(read_landed(spark, path, ERP_STOCK, multi_line=False).drop("project", "day")), target)
    return writers.read(spark, target)


# ------------------------------------------------------------------------------------------------ SRC-17, SNK-7, SNK-8
HISTORY_CONTRACT = [("c_custkey", "bigint"), ("c_name", "string"), ("c_acctbal", "double"), ("note", "string"), ("loaded", "date")]
HISTORY_SQL = """
SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS note, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS loaded FROM customer
"""


@register("history_reread", HISTORY_SQL)
def q_history_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17, SET-2, SNK-7/8: the history exported as CSV on the first day (columns in another order, one missing) is read again by its header, the second day's
    rows are added, and the whole is written anew; read back."""
    rows = table(spark, sf_dir, "customer").select("c_acctbal", "c_name", "c_custkey", (F.col("c_custkey") % 2).alias("odd"))
    first, second = scratch_path(spark, "history-csv"), scratch_path(spark, "history-csv")
    writers.export_csv(rows.filter("odd = 0").drop("odd").withColumn("loaded", F.lit("2024-01-01")), first)
    history = read_history(spark, first, "csv", HISTORY_CONTRACT)
    today = rows.filter("odd = 1").drop("odd").withColumn("loaded", F.lit("2024-01-02").cast("date"))
    writers.export_csv(setops.union_by_name([history, today]), second)
    return read_history(spark, second, "csv", HISTORY_CONTRACT)

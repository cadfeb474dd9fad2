"""ERP profit by product (JOB-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import text_after_last
from ..operators.flatten import explode_with_meta
from ..operators.project import typed

# Sink column -> path in a profit row (missing intermediate objects give null).
ERP_PROFIT_PATHS = {
    "product_name": "assortment.name", "product_code": "assortment.code", "product_article": "assortment.article",
    "product_uom": "assortment.uom.name", "product_href": "assortment.meta.href",
    "sell_quantity": "sellQuantity", "sell_price": "sellPrice", "sell_sum": "sellSum",
    "sell_cost_sum": "sellCostSum", "return_quantity": "returnQuantity", "return_sum": "returnSum",
    "profit": "profit", "margin": "margin", "sales_margin": "salesMargin",
}
ERP_PROFIT_NUMBERS = ["sell_quantity", "sell_price", "sell_sum", "sell_cost_sum", "return_quantity", "return_sum", "profit", "margin", "sales_margin"]
UUID_MARKER = "id="


def erp_profit(payload: DataFrame) -> DataFrame:
    """JOB-18: ``rows[]`` -> one row per product with 15 columns (PRJ-6, missing keys tolerated); the
    product uuid is the text after the last ``id=`` of ``uuidHref`` (null when that is missing or empty;
    SCA-18)."""
    rows = explode_with_meta(payload, "rows")
    cols = [F.col(p).alias(n) for n, p in ERP_PROFIT_PATHS.items()]
    cols.insert(5, text_after_last(F.col("assortment.meta.uuidHref"), UUID_MARKER).alias("product_uuid"))
    return typed(rows.select(*cols), [(c, "double") for c in ERP_PROFIT_NUMBERS])

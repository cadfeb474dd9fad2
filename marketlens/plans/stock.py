"""Stock jobs: warehouse snapshot (JOB-9), ERP stock snapshot (JOB-10), stock and sales alerts (JOB-19)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import to_double, to_wall_clock, upper_or_empty
from ..functions.labels import MARKETPLACE_WB
from ..operators.filters import falling_sales, out_of_stock
from ..operators.flatten import explode_with_meta
from ..operators.project import conform, typed
from ..operators.quality import all_successful
from ..sinks import writers
from ..operators.window import period_change
from ..schemas import STOCKS, WAREHOUSE_DATA_WB

# The product columns kept beside each warehouse row.
WAREHOUSE_META = ["brand", "subjectName", "vendorCode", "inWayToClient", "inWayFromClient",
                  "quantityWarehousesFull"]


def load_stock_snapshot(spark: SparkSession, remains: DataFrame, audit: DataFrame, target: writers.Target,
                        now: dt.datetime | str, projects: Sequence[str]) -> bool:
    """JOB-9 with the source's all-or-nothing rule: the snapshot is appended only when every expected project's
    report response succeeded (SNK-11 audit); otherwise nothing is loaded. Returns whether it loaded."""
    if not all_successful(audit, projects):
        return False
    writers.append(spark, stock_snapshot(remains, now), target)
    return True


def stock_snapshot(remains: DataFrame, now: dt.datetime | str, marketplace: str = MARKETPLACE_WB) -> DataFrame:
    """JOB-9: explode ``warehouses[]`` with the six product columns (PRJ-2; a product with an empty list
    gives no row), stamp the load time and marketplace (PRJ-16/15), upper-case the brand with '' for null
    (SCA-14), in the ``warehouse_data_wb`` contract."""
    keep = [c for c in ("Project",) if c in remains.columns]
    rows = explode_with_meta(remains, "warehouses", meta=WAREHOUSE_META, keep=keep)
    rows = rows.withColumns({"Date": F.lit(str(now)).cast("timestamp_ntz"), "Marketplace": F.lit(marketplace),
                             "brand": upper_or_empty("brand")})
    return conform(typed(rows, WAREHOUSE_DATA_WB), WAREHOUSE_DATA_WB)


# ERP stock column names after flattening (dotted path -> sink column).
ERP_STOCK_PATHS = {
    "assortment.type": "assortment_type", "assortment.code": "assortment_code",
    "assortment.name": "assortment_name", "assortment.gtin": "assortment_gtin",
    "assortment.brand": "assortment_brand", "assortment.state": "assortment_state",
    "assortment.folder": "assortment_folder", "assortment.volume": "assortment_volume",
    "stock.stock": "stock_stock", "stock.transit": "stock_transit", "stock.reserve": "stock_reserve",
    "stock.quantity": "stock_quantity", "stock.days": "stock_days", "stock.cost": "stock_cost",
}


def erp_stock_snapshot(payload: DataFrame) -> DataFrame:
    """JOB-10: ``stocks[]`` -> one row per item (PRJ-7: struct paths renamed to underscore names), the whole
    item, with every key the source sent, as dotted keys and nulls in ``metadata_json`` (PRJ-19), and
    ``moment`` parsed (SCA-6), in the ``stocks`` contract.

    ``payload`` has ``stocks`` as an array of structs; keys beyond the contract's (from an inferred or wider schema) go into the JSON too.
    """
    items = explode_with_meta(payload, "stocks")
    meta = F.to_json(F.struct(*[c.alias(n) for n, c in _dotted(items.schema)]), {"ignoreNullFields": "false"})
    paths = [F.col(p).alias(n) for p, n in ERP_STOCK_PATHS.items()]
    rows = items.select(to_wall_clock("moment").alias("moment"), *paths, meta.alias("metadata_json"))
    return conform(typed(rows, STOCKS), STOCKS)


def _dotted(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, Column]]:
    """Every leaf of a row's structs with its dotted name (arrays count as leaves)."""
    out: list[tuple[str, Column]] = []
    for f in schema.fields:
        own = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            out += _dotted(f.dataType, own)
        else:
            out.append((".".join(own), F.col(".".join(f"`{x}`" for x in own))))
    return out


def stock_alert_out_of_stock(sheet: DataFrame, stock_col: str = "fbo_stock_end") -> DataFrame:
    """JOB-19 (FLT-3): products whose numeric-coerced end-of-period stock is 0."""
    return out_of_stock(sheet, stock_col)


def stock_alert_falling_sales(periods: DataFrame, entity: list[str], period: str, ordered: str,
                              previous_period: Callable[[Column], Column], min_ordered: float = 5,
                              max_change: float = -0.5) -> DataFrame:
    """JOB-19 (WIN-2 + FLT-4): per product and period, the change against the previous period, then the
    products ordering more than ``min_ordered`` whose orders fell by more than half."""
    changed = period_change(periods, entity, period, ordered, previous_period)
    return falling_sales(changed, ordered, "change", min_ordered, max_change)


def sheet_falling_sales(sheet: DataFrame) -> DataFrame:
    """JOB-19 on the monthly sheet as the source reads it: the change column is given (text)."""
    typed = sheet.withColumns({"ordered": to_double("ordered"), "ordered_change": to_double("ordered_change")})
    return falling_sales(typed, "ordered", "ordered_change").select("product_code", "ProductName", "ordered",
                                                                   "fbo_stock_end")

"""Finance jobs: weekly realization report (JOB-12), finance operations (JOB-13), realization by day
(JOB-14). All narrow: one scan, projections, no shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (bool_to_int, empty_strings_to_null, to_double_or_zero, to_long_or_zero,
                               to_wall_clock)
from ..functions.dates import unpadded_date_text
from ..functions.labels import REALIZATION_SOURCE
from ..operators.filters import successful_payloads
from ..operators.flatten import explode_with_meta, first_element_fields, prefixed_struct, recursive_flatten
from ..operators.project import conform, typed
from ..schemas import (OZON_FINANCE, REALIZATION_BOOL_COLUMNS, REALIZATION_DATE_COLUMNS, REALIZATION_NULLABLE_TEXT,
                       WB_FINANCE)

def realization_clean(rows: DataFrame, now: dt.datetime | str, project: str | None = None,
                      source: str = REALIZATION_SOURCE, contract=WB_FINANCE) -> DataFrame:
    """JOB-12: '' becomes null in every text column (SCA-11), project / load time / source are added
    (PRJ-15/16; ``load_dt`` and ``source`` only if absent), dates are parsed with the offset dropped (SCA-5/7), the two
    flags become 0/1 with null kept (SCA-16), missing contract columns are added as nulls and the columns
    are put in contract order (PRJ-18/17)."""
    out = empty_strings_to_null(rows)
    if project is not None:
        out = out.withColumn("project", F.lit(project))
    if "load_dt" not in out.columns:
        out = out.withColumn("load_dt", F.lit(str(now)))
    if "source" not in out.columns:
        out = out.withColumn("source", F.lit(source))
    out = out.withColumns({c: to_wall_clock(c) for c in REALIZATION_DATE_COLUMNS if c in out.columns})
    out = out.withColumns({c: bool_to_int(c) for c in REALIZATION_BOOL_COLUMNS if c in out.columns})
    out = empty_strings_to_null(out, [c for c in REALIZATION_NULLABLE_TEXT if c in out.columns])
    return conform(typed(out, contract), contract)


# Operation fields kept as they are, and the numeric ones.
OPERATION_FIELDS = ["operation_id", "operation_type", "operation_date", "operation_type_name", "delivery_charge",
                    "return_delivery_charge", "accruals_for_sale", "sale_commission", "amount", "type"]
OPERATION_MONEY = ["delivery_charge", "return_delivery_charge", "accruals_for_sale", "sale_commission", "amount"]


def finance_operations(payload: DataFrame, project: str | None = None, all_items: bool = False) -> DataFrame:
    """JOB-13: ``result.operations[]`` -> one row per operation: the base fields, the ``posting`` sub-object
    as ``posting_*`` columns (PRJ-10), the first item and first service (PRJ-9; null when absent), numbers
    cast tolerantly with 0 for bad values (SCA-4), dates parsed (SCA-5), in the ``ozon_finance`` contract.

    ``all_items=True`` is the lossless variant: items and services laid side by side, a row for each place, the shorter list padded with
    nulls. The operation's own amounts stand in its first row and are 0 in the others, so all amounts add up to the payload's.
    """
    keep = [c for c in ("project",) if c in payload.columns]
    ops = explode_with_meta(payload, "result.operations", keep=keep)
    if all_items:
        ops = ops.select("*", F.posexplode_outer(F.arrays_zip(
            F.coalesce("items", F.array()).alias("item"), F.coalesce("services", F.array()).alias("service"))).alias("__place", "__both"))
        ops = ops.withColumns({"items": F.array("__both.item"), "services": F.array("__both.service"),
                               **{c: F.when(F.coalesce("__place", F.lit(0)) == 0, F.col(c)).otherwise("0") for c in OPERATION_MONEY}})
    cols = [*keep, *OPERATION_FIELDS,
            *prefixed_struct("posting", ["delivery_schema", "order_date", "posting_number", "warehouse_id"],
                             "posting_"),
            *first_element_fields("items", {"item_name": "name", "item_sku": "sku"}),
            *first_element_fields("services", {"service_name": "name", "service_price": "price"})]
    rows = ops.select(*cols)
    if project is not None:
        rows = rows.withColumn("project", F.lit(project))
    rows = rows.withColumns({
        "operation_id": to_long_or_zero("operation_id"),
        "item_sku": to_long_or_zero("item_sku"),
        **{c: to_double_or_zero(c) for c in OPERATION_MONEY},
        "operation_date": to_wall_clock("operation_date"),
        "posting_order_date": to_wall_clock("posting_order_date"),
    })
    return conform(typed(rows, OZON_FINANCE), OZON_FINANCE)


def realization_by_day(payloads: DataFrame, day_col: str = "day", array_sizes: dict | None = None) -> DataFrame:
    """JOB-14: successful payloads only (FLT-10: records without ``rows`` are dropped), one row per report
    row, recursively flattened with ``_``-joined paths and arrays by index (PRJ-8), and ``date`` set to the
    request day as unpadded ``Y-M-D`` text (SCA-19), as the source writes it into every row."""
    ok = successful_payloads(payloads, "rows", error_col=None)
    rows = explode_with_meta(ok.select(F.col(day_col).alias("__day"), "rows"), "rows", keep=["__day"])
    flat = recursive_flatten(rows, array_sizes)
    return flat.withColumn("date", unpadded_date_text(F.col("__day"))).drop("__day")

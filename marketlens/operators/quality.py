"""Reconciliation and load checks (AGG-7, AGG-8, SNK-11)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import status_label
from ..functions.labels import AUDIT_ERROR, AUDIT_OK


def reconcile_totals(before: DataFrame, after: DataFrame, columns: Mapping[str, int | None]) -> DataFrame:
    """AGG-7: one row with ``<c>_before``, ``<c>_after`` and ``<c>_diff`` (after - before) per column.

    ``columns`` maps a column to its money scale (decimal sum) or None (integer sum). Both sides are
    tagged and unioned, then summed in a single aggregate: one pass, no join between the two totals.
    """
    cols = list(columns)
    tagged = (before.select(F.lit(0).alias("__side"), *cols)
              .unionByName(after.select(F.lit(1).alias("__side"), *cols)))
    aggs = []
    for c, scale in columns.items():
        typ = "bigint" if scale is None else f"decimal(38,{scale})"
        v = F.col(c).cast(typ)
        for side, suffix in ((0, "before"), (1, "after")):
            total = F.sum(F.when(F.col("__side") == side, v))
            aggs.append(F.coalesce(total, F.lit(0).cast(typ)).alias(f"{c}_{suffix}"))
    out = tagged.agg(*aggs)
    final = []
    for c, scale in columns.items():
        typ = "bigint" if scale is None else "double"
        final += [F.col(f"{c}_before").cast(typ).alias(f"{c}_before"),
                  F.col(f"{c}_after").cast(typ).alias(f"{c}_after"),
                  (F.col(f"{c}_after") - F.col(f"{c}_before")).cast(typ).alias(f"{c}_diff")]
    return out.select(*final)


def rows_per_project(df: DataFrame, project_col: str = "project") -> DataFrame:
    """AGG-8: row count per project."""
    return df.groupBy(project_col).agg(F.count(F.lit(1)).alias("n_rows"))


def load_audit(responses: DataFrame, loaded_at: dt.datetime | str, api_col: str = "project",
               code_col: str = "status_code", text_col: str = "text", ok_code: int = 200) -> DataFrame:
    """SNK-11: one row per landed response (API, Status Code, Status, Response Text, Date): the status
    label is 'Successful' for ``ok_code`` and 'Error' otherwise (SCA-24); Date is the load time."""
    code = F.col(code_col)
    return responses.select(
        F.col(api_col).cast("string").alias("API"), code.cast("int").alias("Status Code"),
        status_label(code, ok_code, AUDIT_OK, AUDIT_ERROR).alias("Status"),
        F.col(text_col).cast("string").alias("Response Text"),
        F.lit(str(loaded_at)).cast("timestamp_ntz").alias("Date"))


def response_audit(responses: DataFrame, loaded_at: dt.datetime | str, api_col: str = "project", keep: Sequence[str] = ("day",)) -> DataFrame:
    """SNK-11 over ``sources.landed.landed_responses``: a row for each landed file with the number of its sound pages (200), and one for each text
    of a damaged page in it (500), with the columns ``keep``. All comes from the responses themselves: nothing is joined.

    Sound pages of a file are counted on every map task before the shuffle, so a file with a third of all pages is no hot key.
    """
    rows = responses.groupBy(api_col, *keep, "file", "bytes", "landed_at", "text").agg(F.count(F.lit(1)).alias("Pages"))
    code = F.when(F.col("text").isNull(), 200).otherwise(500)
    return rows.select(F.col(api_col).cast("string").alias("API"), *keep, F.col("file").alias("File"), F.col("bytes").alias("Bytes"),
                       F.col("landed_at").alias("Landed At"), "Pages", code.alias("Status Code"),
                       status_label(code, 200, AUDIT_OK, AUDIT_ERROR).alias("Status"), F.col("text").alias("Response Text"),
                       F.lit(str(loaded_at)).cast("timestamp_ntz").alias("Date"))


def all_successful(audit: DataFrame, expected: Sequence[str]) -> bool:
    """Precondition for all-or-nothing loads: every expected project has a response and none of all responses failed.

    An empty audit, or one that lacks a project, does not pass. Reads a row for each project."""
    by_api = {r["API"]: r["ok"] for r in audit.groupBy("API").agg(F.bool_and(F.col("Status") == AUDIT_OK).alias("ok")).collect()}
    return bool(expected) and all(by_api.get(p) for p in expected) and all(by_api.values())

"""Product funnel (JOB-8): funnel card pages -> ``order_history_wb`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.clean import to_wall_clock, upper_keep_null
from ..operators.project import conform
from ..schemas import ORDER_HISTORY_WB
from .ads import flatten_funnel_cards


def funnel_daily(pages: DataFrame) -> DataFrame:
    """JOB-8: flatten cards (PRJ-5), upper-case the brand with nulls kept (SCA-15), keep the 18 contract
    columns (PRJ-12) with ``begin`` as a timestamp."""
    rows = flatten_funnel_cards(pages)
    rows = rows.withColumns({"brandName": upper_keep_null("brandName"), "begin": to_wall_clock("begin")})
    return conform(rows, ORDER_HISTORY_WB)

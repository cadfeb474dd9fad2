"""Sorts and top-k (SRT-1 to SRT-4). Sorting is for presentation; pipelines feeding joins or sinks do not
sort. ``top_k`` plans as ``TakeOrderedAndProject``: each task keeps its own k best rows, so only
k x tasks rows reach the final merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, column: str, tiebreak: Sequence[str] = ()) -> DataFrame:  # SRT-1, SRT-2
    return df.orderBy(F.col(column).desc(), *[F.col(c).asc() for c in tiebreak])


def top_k(df: DataFrame, column: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:  # SRT-3
    return sort_desc(df, column, tiebreak).limit(k)


def head(df: DataFrame, n: int = 5) -> DataFrame:  # SRT-4 (a sample for display; the limit is the feature)
    return df.limit(n)

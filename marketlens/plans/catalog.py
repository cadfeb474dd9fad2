"""Registered queries: each runs a library job over the supplied tables, with its DuckDB oracle SQL.

Every query reads whole tables (no id subsets, no row caps). Column names and types are aliased identically
on both sides; money sums are decimal, means are rounded to 6 places, so values hash identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        known = QUERIES.get(name)
        if known is not None and (known.__module__, known.__qualname__) != (fn.__module__, fn.__qualname__):
            raise ValueError(f"two different queries registered as {name}")  # a re-import is fine
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


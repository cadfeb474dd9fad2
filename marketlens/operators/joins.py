"""Joins (JON-1 to JON-6). Every join the source makes is a left equi-join; JON-6 is a semi join.

Broadcast policy: no hint unless a side is bounded by construction (a k-row top list, a calendar); everything else is left to
Catalyst and AQE, which broadcast on measured size or else sort-merge join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(facts: DataFrame, other: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Facts LEFT JOIN other on equal key names (JON-1/2/3).

    ``null_safe`` joins null keys to null keys (pandas ``merge`` parity); the default is SQL semantics. AQE splits a skewed key of
    the left side; a right side with many rows for a key belongs pre-aggregated to that key.
    """
    on = list(on)
    if not null_safe:
        return facts.join(other, on, "left")
    right = other.select(*[F.col(k).alias(f"__r_{k}") for k in on],
                         *[c for c in other.columns if c not in on])
    cond = None
    for k in on:
        term = facts[k].eqNullSafe(right[f"__r_{k}"])
        cond = term if cond is None else cond & term
    return facts.join(right, cond, "left").drop(*[f"__r_{k}" for k in on])


def left_join_renamed(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    """JON-4: keys with different names. The right keys are renamed to the left names before the join, so
    the result has one copy of each key."""
    renamed = right.withColumnsRenamed(dict(zip(right_on, left_on)))
    return left_join(left, renamed, left_on)


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """JON-6: keep rows of ``df`` whose key occurs in ``keys`` (left semi join; no duplication)."""
    return df.join(keys.select(*on), list(on), "left_semi")

"""Counted casts (SCA-6, FLT-6): how many values of each column were read, null, and not castable, in the pass that writes the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import writers


class TooManyBadValues(ValueError):
    """A column's share of values that do not cast is above the limit; nothing was loaded."""


def counted_casts(df: DataFrame, casts: Mapping[str, Column], name: str = "casts") -> tuple[DataFrame, Observation]:
    """``df`` with each column of ``casts`` replaced by its expression (a tolerant cast, null for bad values), and the counts as an observation.

    The counts are taken while the result is computed, in no pass of their own; ``cast_counts`` reads them once an action has run.
    A value counts as failed if it was not null and its cast is.
    """
    observation = Observation(name)
    raw = df.withColumns({f"__raw_{c}": F.col(f"`{c}`") for c in casts})
    cast = raw.withColumns(dict(casts))
    counts = [F.count(F.lit(1)).alias("read")]
    for c in casts:
        null = F.col(f"`__raw_{c}`").isNull()
        counts += [F.count_if(null).alias(f"null {c}"), F.count_if(~null & F.col(f"`{c}`").isNull()).alias(f"failed {c}")]
    return cast.observe(observation, *counts).drop(*[f"__raw_{c}" for c in casts]), observation


def cast_counts(observation: Observation, columns: list[str]) -> list[tuple[str, int, int, int]]:
    """(column, values read, null, failed) for each column, after an action on the observed frame."""
    got = observation.get
    return [(c, int(got["read"]), int(got[f"null {c}"]), int(got[f"failed {c}"])) for c in columns]


def append_checked(spark: SparkSession, df: DataFrame, casts: Mapping[str, Column], target: writers.Target,
                   most_failed: float = 0.01) -> list[tuple[str, int, int, int]]:
    """Cast, count and append in the sink's columns; above ``most_failed`` of a column's non-null values nothing is loaded and TooManyBadValues raised.

    The cast rows are written once to the shared folder; the table gets them from there, after the counts are known.
    """
    cast, observation = counted_casts(df, casts)
    path = scratch_path(spark, "checked-load")
    cast.write.parquet(path)
    counts = cast_counts(observation, list(casts))
    if bad := [f"{c}: {failed} of {read - null}" for c, read, null, failed in counts if failed > most_failed * (read - null)]:
        raise TooManyBadValues("; ".join(bad))
    writers.append(spark, spark.read.schema(cast.schema).parquet(path), target)
    return counts

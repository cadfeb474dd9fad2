"""Set operations (SET-1 to SET-3): unions by column name. A union is narrow (no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1/2/3: union by column name, missing columns null, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_projects(frames: Mapping[str, DataFrame], project_col: str = "Project") -> DataFrame:
    """SET-1 + PRJ-15: tag each frame with its project, then union by name."""
    return union_by_name([df.withColumn(project_col, F.lit(p)) for p, df in frames.items()])

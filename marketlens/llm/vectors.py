"""Reading columns of vectors into numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def sound(column: str) -> Column:
    """True for vectors that are not null or empty and hold no null or non-finite component."""
    return F.coalesce((F.size(column) > 0) & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def by_dimension(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors (float64), for each number of components among the vectors, which must be sound."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten()).astype(np.float64)
    ends = np.cumsum(lengths)
    out = []
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        out.append((rows, flat[(ends[rows] - d)[:, None] + np.arange(d)]))
    return out

"""Projections (PRJ-12 to PRJ-19): keep, drop, rename, literals, load time, contract conformance, row JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import to_double, to_long


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:  # PRJ-12
    return df.select(*columns)


def drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:  # PRJ-13
    return df.drop(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:  # PRJ-14
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, contract: Sequence[tuple[str, str]], cast_present: bool | str = False) -> DataFrame:
    """PRJ-17/18: reorder to the contract; absent columns are added as typed nulls. With ``cast_present``
    present columns are also converted to the contract type: tolerantly (``True``: bad values become null)
    or ``"strict"`` (a value that does not fit fails, as a table write should)."""
    cols: list[Column] = []
    for name, typ in contract:
        if name in df.columns:
            c = F.col(f"`{name}`")
            if cast_present == "strict":
                c = c.cast(typ)
            elif cast_present:
                c = c.try_cast(typ)
            cols.append(c.alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    return df.select(*cols)


def typed(df: DataFrame, types: Sequence[tuple[str, str]]) -> DataFrame:
    """SCA-3 by a list of (column, type): numeric columns that are present as text are cast tolerantly (a fraction in a whole-number
    column is cut, bad text becomes null); other columns stay as they are."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    whole = {"bigint", "int", "tinyint"}
    return df.withColumns({c: to_double(c) if t == "double" else to_long(c).try_cast(t)
                           for c, t in types if c in text and (t == "double" or t in whole)})


def row_to_json(df: DataFrame, column: str = "metadata_json", timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss",
                columns: Sequence[str] | None = None) -> DataFrame:
    """PRJ-19: serialise the row to JSON text. Nulls are written (``ignoreNullFields=false``); timestamps
    as ISO text."""
    src = columns if columns is not None else df.columns
    opts = {"ignoreNullFields": "false", "timestampFormat": timestamp_format,
            "timestampNTZFormat": timestamp_format}
    return df.withColumn(column, F.to_json(F.struct(*[F.col(f"`{c}`") for c in src]), opts))

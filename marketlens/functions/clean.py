"""Scalar cleaning functions (SCA-1 to SCA-25): Column in, Column out, all JVM-side built-ins.

ANSI mode is on, so landed text is never cast with a plain ``cast``: every tolerant conversion goes through
``try_cast`` / ``try_to_timestamp`` and yields null on bad input.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labels import NULL_DATE_SENTINEL

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_map(mapping: Mapping) -> Column:
    """A ``MapType`` literal built from a Python dict (keys keep their Python type)."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


# SCA-1: code to label, unknown codes kept (as text).
def label_or_code(c: ColumnOrName, mapping: Mapping) -> Column:
    c = _c(c)
    return F.coalesce(label_map(mapping)[c], c.cast("string"))


# SCA-2: code to label, unknown becomes null.
def label_or_null(c: ColumnOrName, mapping: Mapping) -> Column:
    return label_map(mapping)[_c(c)]


# What any text that casts to a number begins with. A failed cast to double costs an exception, so other text is not tried.
NUMBER_START = r"^[\x00-\x20]*[+\-]?[0-9.iInN]"


# SCA-3: tolerant numeric cast. Text "NaN" parses to NaN in Spark; it is made null, so that the 0-filling
# of SCA-4 applies to it as to any other non-number.
def to_double(c: ColumnOrName) -> Column:
    text = _c(c).cast("string")
    return F.nanvl(F.when(text.rlike(NUMBER_START), text.try_cast("double")), F.lit(None).cast("double"))


def tolerant_doubles(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """SCA-3 over a column list that may be partly absent: only present columns are cast."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_double(c) for c in present}) if present else df


def to_long(c: ColumnOrName) -> Column:
    """Whole numbers exactly (ids beyond 2**53 too); other numbers with the fraction cut; bad text null."""
    text = _c(c).cast("string")
    return F.coalesce(text.try_cast("bigint"), to_double(text).try_cast("bigint"))


# SCA-4: tolerant cast, then 0, then int64 (fraction truncated) or float64.
def to_long_or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(to_long(c), F.lit(0).cast("bigint"))


def to_double_or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


# SCA-5 / SCA-7: tolerant timestamp parse. A timestamp_ntz cast keeps the wall clock and ignores an offset.
def to_wall_clock(c: ColumnOrName) -> Column:
    return _c(c).cast("string").try_cast("timestamp_ntz")


# SCA-6: parse with a list of formats, first that fits wins.
def parse_timestamp_formats(c: ColumnOrName, formats: Iterable[str]) -> Column:
    """ISO text (with or without offset) is read as wall clock first; other shapes by the listed formats
    (read in the session time zone, UTC, so without shifting)."""
    c = _c(c).cast("string")
    return F.coalesce(to_wall_clock(c), *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


# SCA-10: sentinel for a null date; dates outside the pandas range are treated as null first.
PANDAS_MIN_TS = "1677-09-22 00:00:00"
PANDAS_MAX_TS = "2262-04-11 00:00:00"


def date_or_sentinel(c: ColumnOrName, sentinel: str = NULL_DATE_SENTINEL) -> Column:
    ts = to_wall_clock(c)
    in_range = ts.between(F.lit(PANDAS_MIN_TS).cast("timestamp_ntz"), F.lit(PANDAS_MAX_TS).cast("timestamp_ntz"))
    return F.coalesce(F.when(in_range, ts), F.lit(sentinel).cast("timestamp_ntz"))


# SCA-11: empty string to null.
def empty_to_null(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(""))


def empty_strings_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """SCA-11 over listed columns (default: every string column present)."""
    wanted = set(columns) if columns is not None else None
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
            and (wanted is None or f.name in wanted)]
    return df.withColumns({c: empty_to_null(c) for c in cols}) if cols else df


# SCA-12: NaN to null for double columns.
def nan_to_null(c: ColumnOrName) -> Column:
    return F.nanvl(_c(c), F.lit(None).cast("double"))


# SCA-13: null to 0 for listed columns (fillna keeps the column type).
def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.fillna(0, subset=[c for c in columns if c in df.columns])


# SCA-14 / SCA-15: upper case, with or without '' for null.
def upper_or_empty(c: ColumnOrName) -> Column:
    return F.coalesce(F.upper(_c(c)), F.lit(""))


def upper_keep_null(c: ColumnOrName) -> Column:
    return F.upper(_c(c))


# SCA-16: boolean to int (null stays null).
def bool_to_int(c: ColumnOrName) -> Column:
    return _c(c).cast("int")


# SCA-17: map each array element with fallback to the element itself, then join.
def map_and_join(c: ColumnOrName, mapping: Mapping, sep: str = ", ") -> Column:
    m = label_map(mapping)
    return F.array_join(F.transform(_c(c), lambda x: F.coalesce(m[x], x)), sep)


# SCA-18: text after the last marker; null when the text is missing or empty. Text without the marker is
# returned whole, and text ending with the marker gives '' (the source's split-and-take-last).
def text_after_last(c: ColumnOrName, marker: str) -> Column:
    return F.substring_index(F.nullif(_c(c), F.lit("")), marker, -1)


# SCA-24: conditional label.
def status_label(code: ColumnOrName, ok_code: int, ok_text: str, error_text: str) -> Column:
    return F.when(_c(code) == ok_code, F.lit(ok_text)).otherwise(F.lit(error_text))


# SCA-25: default for a missing key.
def with_default(c: ColumnOrName, default) -> Column:
    return F.coalesce(_c(c), F.lit(default))

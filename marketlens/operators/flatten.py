"""Flattening nested landed JSON (PRJ-1 to PRJ-11).

All of it is ``Generate`` and struct field access: narrow, no shuffle. Explodes are inner in effect: the
source drops a parent whose array is empty or missing, and so do we (see ``_elements`` for how).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _elements(df: DataFrame, array_col: str, cols: Sequence[str], pos_name: str = "__pos") -> DataFrame:
    """One row per array element with its position; rows whose array is empty or null vanish.

    Written as ``posexplode_outer`` + ``pos IS NOT NULL`` rather than an inner generator: for an inner one
    the optimizer infers ``size(arr) > 0`` and pushes it below the projection that produced ``arr``; when
    that is ``from_json`` the whole parse is evaluated twice. Same rows, one parse.
    """
    return (df.select(*cols, F.posexplode_outer(array_col).alias(pos_name, "__elem"))
            .filter(F.col(pos_name).isNotNull()))


def explode_with_meta(df: DataFrame, array_col: str, meta: Sequence[str] = (),
                      keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-1/2/4/11: one row per element of ``array_col`` (struct fields become columns), with the parent
    columns ``meta`` and pass-through columns ``keep``. Empty or null arrays yield no rows."""
    cols = [*keep, *meta]
    return _elements(df, array_col, cols).select(*cols, "__elem.*")


def explode_positions(df: DataFrame, array_col: str, pos_name: str, keep: Sequence[str]) -> DataFrame:
    """Like ``explode_with_meta`` but also keeps the element position (for order-free "first")."""
    return _elements(df, array_col, keep, pos_name).select(*keep, pos_name, "__elem.*")


def select_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """PRJ-5/6/7/10: output column -> dotted struct path. A missing intermediate struct gives null."""
    return df.select(*[F.col(p).alias(name) for name, p in paths.items()])


def _field(name: str):
    return lambda x: x.getField(name)


def measured_array_sizes(df: DataFrame) -> dict[str, int]:
    """Largest size of every array, arrays inside arrays and structs too, in one aggregate job. Keys are the names of ``recursive_flatten`` without
    indexes: ``rows_vals`` for ``rows[].vals``, ``m_`` for the inner arrays of ``m[][]``."""
    found: dict[str, Column] = {}

    def walk(c: Column, t: T.DataType, name: str, spread_out: bool) -> None:
        # spread_out: c is an array with a value for each element above it
        if isinstance(t, T.StructType):
            for f in t.fields:
                own = F.transform(c, _field(f.name)) if spread_out else c.getField(f.name)
                walk(own, f.dataType, f"{name}_{f.name}", spread_out)
        elif isinstance(t, T.ArrayType):
            found[name] = F.coalesce(F.array_max(F.transform(c, F.size)), F.lit(0)) if spread_out else F.size(c)
            inner = F.flatten(F.filter(c, lambda x: x.isNotNull())) if spread_out else c
            walk(inner, t.elementType, f"{name}_" if isinstance(t.elementType, T.ArrayType) else name, True)

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f.name, False)
    if not found:
        return {}
    row = df.agg(*[F.max(c).alias(k) for k, c in found.items()]).first()
    return {k: max(int(v or 0), 0) for k, v in row.asDict().items()}


def recursive_flatten(df: DataFrame, array_sizes: Mapping[str, int] | None = None, sep: str = "_", max_columns: int = 10_000) -> DataFrame:
    """PRJ-8: every leaf becomes a column named by its path joined with ``sep``; an array becomes one column
    per index (``name_0``, ``name_1``, ...) up to the largest size in the data, at any depth; struct elements of arrays are walked
    further. Element access is ``get`` (null past the end).

    ``array_sizes`` (keys as in ``measured_array_sizes``) can only add columns: a declared size below the data's is raised to it, so no
    value is lost. More than ``max_columns`` columns raise an error. Only the schema is walked on the driver.
    """
    sizes = measured_array_sizes(df)
    for k, n in (array_sizes or {}).items():
        sizes[k] = max(n, sizes.get(k, 0))
    cols: list[Column] = []

    def walk(c: Column, t: T.DataType, name: str, size_key: str) -> None:
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk(c.getField(f.name), f.dataType, f"{name}{sep}{f.name}", f"{size_key}_{f.name}")
        elif isinstance(t, T.ArrayType):
            below = f"{size_key}_" if isinstance(t.elementType, T.ArrayType) else size_key
            for i in range(sizes.get(size_key, 0)):
                walk(F.get(c, i), t.elementType, f"{name}{sep}{i}", below)
        else:
            if len(cols) == max_columns:
                raise ValueError(f"more than {max_columns} columns: explode the longest arrays ({sizes}) instead")
            cols.append(c.alias(name))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f.name, f.name)
    return df.select(*cols)


def variant_leaves(df: DataFrame, json_col: str, keep: Sequence[str] = (), sep: str = "_", max_depth: int = 12) -> DataFrame:
    """PRJ-8 in long form, for documents of any width: a row (``keep``, ``path``, ``value``) for each leaf of a JSON text, in one pass.

    Paths and leaves are those of ``recursive_flatten``: names and indexes joined with ``sep``, empty objects and arrays vanish. The text is parsed once
    to a VARIANT; each level of nesting is one generator in the same stage, so the number of paths has no limit. ``value`` is the leaf's text
    (null for a JSON null). Text that is no JSON gives no rows; a leaf deeper than ``max_depth`` raises an error, nothing is dropped.
    """
    spark = df.sparkSession
    level = df.select(*keep, F.lit("").alias("path"), F.try_parse_json(F.col(json_col)).alias("v")).filter(F.col("v").isNotNull())
    step = (f"SELECT {''.join(f'`{c}`, ' for c in keep)} t.v AS up, e.pos AS pos, e.value AS below, "
            "CASE WHEN e.pos IS NULL THEN t.path ELSE concat(t.path, if(t.path = '', '', :sep), coalesce(e.key, cast(e.pos AS string))) END AS path "
            "FROM {level} t, LATERAL variant_explode_outer(t.v) e")
    for _ in range(max_depth):
        level = spark.sql(step, args={"sep": sep}, level=level).select(*keep, "path", F.when(F.col("pos").isNull(), F.col("up")).otherwise(F.col("below")).alias("v"))
    text = F.expr("try_variant_get(v, '$', 'string')")
    kind = F.schema_of_variant("v")
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    empty = text.isin("{}", "[]")
    deep = F.raise_error(F.concat(F.lit(f"nested deeper than {max_depth} levels: "), F.col("path")))
    return level.filter(~(nested & empty)).select(*keep, "path", F.when(nested, deep.cast("string")).otherwise(text).alias("value"))


def first_element_fields(array_col: str, fields: Mapping[str, str]) -> list[Column]:
    """PRJ-9: fields of the first array element, null when the array is empty or null. ``get`` never
    raises, where ``arr[0]`` does under ANSI on an empty array."""
    first = F.get(F.col(array_col), 0)
    return [first.getField(f).alias(name) for name, f in fields.items()]


def prefixed_struct(struct_col: str, fields: Sequence[str], prefix: str) -> list[Column]:
    """PRJ-10: an optional sub-object flattened to prefixed columns (all null when it is absent)."""
    return [F.col(struct_col).getField(f).alias(f"{prefix}{f}") for f in fields]

"""Typed readers for landed source data (SRC-1 to SRC-18).

The HTTP collection is out of scope: each source is landed as JSON files per project and day
(``<root>/project=<p>/day=<d>/*.json``); pages and id chunks of one request are simply more files, so
concatenating them (SET-3) is the multi-file read itself. Every read has an explicit schema: no inference
pass over the data, and a missing key becomes null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PRODUCT_STATS_COLUMNS


CORRUPT = "_corrupt_record"


def read_landed(spark: SparkSession, path: str | Sequence[str], schema: str | None, multi_line: bool = True,
                keep_corrupt: bool = False) -> DataFrame:
    """SRC-1..16: one JSON document per file (``multi_line``) or one per line. ``project=``/``day=``
    directories below ``path`` become columns by partition discovery (and are pruned by filters).

    Without a ``schema`` (sources whose keys are not fixed) it is read from the data in a pass of its own, every key that any
    document has, with numbers as text.

    A document that does not parse (a truncated page) stops the read. With ``keep_corrupt`` it becomes a row with its text in
    ``_corrupt_record`` instead, for ``split_corrupt`` and the load audit.
    """
    if not keep_corrupt:
        reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
        reader = reader.schema(schema) if schema else reader.option("primitivesAsString", True)
        return reader.json(path if isinstance(path, str) else list(path))
    if not schema:
        raise ValueError("keep_corrupt needs a schema")
    raw = spark.read.text(path if isinstance(path, str) else list(path), wholetext=multi_line)
    one = T.StructType([*T.StructType.fromDDL(schema), T.StructField(CORRUPT, T.StringType())])
    text, options = F.trim("value"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    docs = F.when(text.startswith("["), F.from_json(text, T.ArrayType(one), options)).otherwise(F.array(F.from_json(text, one, options)))
    kept = [c for c in raw.columns if c != "value"]
    rows = raw.filter(text != "").select("value", *kept, docs.alias("__docs"))
    # Text that gives no documents at all is one damaged document; an empty list is none.
    rows = rows.select("value", *kept, F.explode(F.coalesce("__docs", F.array(F.lit(None).cast(one)))).alias("__doc"))
    damaged = F.when(F.col("__doc").isNull(), F.col("value")).otherwise(F.col(f"__doc.{CORRUPT}"))
    return rows.select(*[F.col(f"__doc.{f.name}").alias(f.name) for f in one if f.name != CORRUPT], damaged.alias(CORRUPT), *kept)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound documents without the corrupt-record column, and the texts of the damaged ones with the other scalar columns."""
    simple = [f.name for f in df.schema if f.dataType.typeName() not in ("array", "struct", "map")]
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull()).select(*simple)


def landed_responses(spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = True) -> DataFrame:
    """A row for each landed response (a file with ``multi_line``, else a line): the folder columns, ``file``, ``bytes`` and ``landed_at`` of its
    file (from the file source's hidden metadata), and ``text``: null for a response that parses, else the whole of it.

    A page is damaged if any of its documents is. Blank lines are no responses, and Spark's file sources pass over empty files: what was
    not answered shows by its absence, which ``all_successful`` and ``page_problems`` look for.
    """
    raw = spark.read.text(path if isinstance(path, str) else list(path), wholetext=multi_line)
    one = T.StructType([*T.StructType.fromDDL(schema), T.StructField(CORRUPT, T.StringType())])
    body, options = F.trim("value"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    docs = F.when(body.startswith("["), F.from_json(body, T.ArrayType(one), options)).otherwise(F.array(F.from_json(body, one, options)))
    sound = F.coalesce(F.forall(docs, lambda d: d.isNotNull() & d[CORRUPT].isNull()), F.lit(False)) & (body != "")
    folders = [c for c in raw.columns if c != "value"]
    rows = raw if multi_line else raw.filter(body != "")
    return rows.select(*folders, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                       F.col("_metadata.file_modification_time").alias("landed_at"), F.when(~sound, F.col("value")).alias("text"))


def parse_json_text(df: DataFrame, text_col: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The same typed read for payloads that arrive as a text column (a message, a staging table)."""
    return df.select(*keep, F.from_json(F.col(text_col), schema).alias("__doc")).select(*keep, "__doc.*")


def read_report(spark: SparkSession, json_path: str | None = None, csv_path: str | None = None,
                columns: Sequence[str] = PRODUCT_STATS_COLUMNS, multi_line: bool = True, **options) -> DataFrame:
    """SRC-13/14: a text-valued report landed as JSON (one document a file with ``multi_line``, else one a line) or as header CSV (the source
    decides by content type). Both are bound to ``columns`` by name (a CSV read with a schema would bind by position and ignore the
    header), absent columns are null, and the two are unioned. ``options`` go to both readers."""
    frames = []
    if json_path:
        schema = ", ".join(f"`{c}` string" for c in columns)
        frames.append(spark.read.options(**options.get("json", {})).schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST").json(json_path))
    if csv_path:
        raw = spark.read.options(**options.get("csv", {})).option("header", True).option("inferSchema", False).csv(csv_path)
        frames.append(raw.select(*[F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string").alias(c)
                                   for c in columns]))
    if not frames:
        raise ValueError("a report needs a JSON or a CSV path")
    return reduce(DataFrame.unionByName, frames)


def read_report_folder(spark: SparkSession, path: str, columns: Sequence[str] = PRODUCT_STATS_COLUMNS, multi_line: bool = True) -> DataFrame:
    """SRC-13 on a landed folder that holds both kinds of responses: ``*.json`` and ``*.csv`` files, at any depth."""
    def only(glob: str) -> dict:
        return {"pathGlobFilter": glob, "recursiveFileLookup": True}

    def has(glob: str) -> bool:
        return not spark.read.format("binaryFile").options(**only(glob)).load(path).select("path").limit(1).isEmpty()

    return read_report(spark, path if has("*.json") else None, path if has("*.csv") else None, columns, multi_line,
                       json=only("*.json"), csv=only("*.csv"))


def read_history(spark: SparkSession, path: str, fmt: str = "parquet",
                 contract: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """SRC-17: re-read of the previously exported history (spreadsheets re-aimed as CSV or Parquet). A CSV
    is bound to the contract by header name and cast tolerantly (absent columns null)."""
    from ..operators.project import conform

    if fmt == "csv":
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
        return conform(raw, contract, cast_present=True) if contract else raw
    df = spark.read.parquet(path)
    return conform(df, contract) if contract else df

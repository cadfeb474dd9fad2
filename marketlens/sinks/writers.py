"""Sinks (SNK-1 to SNK-11) over Parquet tables stored at a path, partitioned by a column such as ``day``.

A table is a :class:`Target`: a path (on a cluster, in the shared file system), an ordered column contract
and its partition columns. Reads use the contract as the schema (no footer inference; partition values come
from directory names). Writes bind columns by name (the frame is put in contract order first).

Partition bookkeeping stays in the file system: there is no per-partition catalog call, so loading thousands
of days costs one write job, not thousands of metadata updates. Reads of the target that feed a write into
the same target are materialised first with a reliable ``checkpoint()`` in the shared folder, so the
overwrite never deletes files its own input still needs, and a lost executor recomputes from the checkpoint.

Rows are dealt by partition value with a REBALANCE hint: many small days share a task, and a day above the advisory partition size is
split over several by its bytes as measured, whatever share of the load it has. The partitions of small loads stay apart, so that all cores write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import conform
from ..operators.window import latest_version
from ..schemas import ddl
from ..session import shared_dir, spread_small


@dataclass(frozen=True)
class Target:
    path: str
    contract: Sequence[tuple[str, str]]
    partition_by: Sequence[str] = field(default_factory=tuple)

    @property
    def schema(self) -> str:
        return ddl(self.contract)

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.contract]


def read(spark: SparkSession, target: Target) -> DataFrame:
    """SRC-18: scan of a sink table with its declared schema; filters on partition columns prune directories."""
    return spark.read.schema(target.schema).parquet(target.path).select(*[F.col(f"`{c}`") for c in target.columns])


def create_table(spark: SparkSession, target: Target, catalog_name: str | None = None) -> None:
    """SNK-6: create the table if it does not exist (an existing table is left as it is), optionally also
    registered in the catalog for SQL users."""
    empty = spark.createDataFrame([], target.schema)
    writer = empty.write.mode("ignore")
    if target.partition_by:
        writer = writer.partitionBy(*target.partition_by)
    writer.parquet(target.path)
    if catalog_name:
        register_catalog_table(spark, target, catalog_name)


def register_catalog_table(spark: SparkSession, target: Target, name: str) -> None:
    """Expose a path table to SQL users under ``name`` (declared types and partitioning), with the
    partitions present on disk recovered. Loads go through the path; run ``ALTER TABLE ... RECOVER
    PARTITIONS`` (this function again) after a load that adds days, or read with :func:`read`."""
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in target.partition_by)})" if target.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({target.schema}) USING parquet{parts} LOCATION '{target.path}'")
    if target.partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _prepared(df: DataFrame, target: Target) -> DataFrame:
    """Contract order and types (absent columns null, a value that does not fit its type fails the write), dealt by partition value."""
    out = conform(df, target.contract, cast_present="strict")
    return out.hint("rebalance", *[F.col(f"`{c}`") for c in target.partition_by]) if target.partition_by else out


def _writer(df: DataFrame, target: Target, mode: str, dynamic: bool = False):
    w = df.write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if target.partition_by:
        w = w.partitionBy(*target.partition_by)
    return w


def append(spark: SparkSession, df: DataFrame, target: Target) -> None:
    """SNK-1 / SNK-8: append rows in the contract's columns (missing ones null), bound by name. Run twice, it adds them twice;
    ``append_once`` does not."""
    rows = _prepared(df, target)
    with spread_small(rows):
        _writer(rows, target, "append").parquet(target.path)


LOADS = [("load_id", "string"), ("unit", "string"), ("rows", "bigint"), ("loaded_at", "timestamp_ntz")]
LOAD_ID = "load_id"


def once_target(path: str, contract: Sequence[tuple[str, str]], unit: Sequence[str]) -> Target:
    """A table for ``append_once``: the contract's columns and the load's id, partitioned by the load and its units (such as project and day)."""
    return Target(path, [*contract, (LOAD_ID, "string")], (LOAD_ID, *unit))


def ledger_target(target: Target) -> Target:
    """The table of finished units beside ``target``: load id, unit, its rows and when it was loaded."""
    return Target(f"{target.path.rstrip('/')}__loads", LOADS)


def _unit(target: Target) -> Column:
    """A unit's partition values as JSON text, nulls kept."""
    units = [F.col(f"`{c}`").cast("string").alias(c) for c in target.partition_by if c != LOAD_ID]
    return F.to_json(F.struct(*units), {"ignoreNullFields": "false"})


def append_once(spark: SparkSession, df: DataFrame, target: Target, load_id: str, now: dt.datetime | str) -> None:
    """SNK-1 that may be run again: the rows of ``df`` as load ``load_id`` of a ``once_target``; units that the ledger lists for this load stay.

    The other units' folders (which only this load writes) are overwritten and then entered in the ledger. After a crash in between the
    folders hold rows that the ledger does not know: ``read_loaded`` does not see them, and the next run of the load overwrites them.
    A unit is written whole, so run a load with all rows of its units. Units with a third of the rows are split by REBALANCE.
    """
    ledger = ledger_target(target)
    create_table(spark, ledger)
    done = read(spark, ledger).filter(F.col("load_id") == load_id).select(F.col("unit").alias("__unit"))
    rows = conform(df.withColumn(LOAD_ID, F.lit(load_id)), target.contract, cast_present="strict")
    overwrite_partitions(spark, rows.join(done, _unit(target) == F.col("__unit"), "left_anti"), target)
    # What the folders of this load now hold and the ledger lacks: a row for each unit, counted from the files written.
    held = (_stored(spark, target).filter(F.col(LOAD_ID) == load_id).groupBy(_unit(target).alias("unit")).agg(F.count(F.lit(1)).alias("rows"))
            .join(done, F.col("unit") == F.col("__unit"), "left_anti"))
    append(spark, held.select(F.lit(load_id).alias("load_id"), "unit", "rows", F.lit(str(now)).cast("timestamp_ntz").alias("loaded_at")), ledger)


def read_loaded(spark: SparkSession, target: Target) -> DataFrame:
    """The contract's rows of all units that the ledger lists."""
    done = read(spark, ledger_target(target)).select(F.col("load_id").alias("__load"), F.col("unit").alias("__unit")).distinct()
    rows = _stored(spark, target)
    return rows.join(done, (rows[LOAD_ID] == F.col("__load")) & (_unit(target) == F.col("__unit")), "left_semi").drop(LOAD_ID)


def overwrite_partitions(spark: SparkSession, df: DataFrame, target: Target) -> None:
    """Replace exactly the partitions that occur in ``df`` (dynamic partition overwrite)."""
    rows = _prepared(df, target)
    with spread_small(rows):
        _writer(rows, target, "overwrite", dynamic=True).parquet(target.path)


def empty_partition(spark: SparkSession, target: Target, values: dict) -> None:
    """Delete one partition's rows: overwrite its directory with an empty frame."""
    sub = "/".join(f"{k}={v}" for k, v in values.items())
    rest = [(c, t) for c, t in target.contract if c not in values]
    spark.createDataFrame([], ddl(rest)).write.mode("overwrite").parquet(f"{target.path.rstrip('/')}/{sub}")


def reload_window(spark: SparkSession, df: DataFrame, target: Target, first: dt.date | str, last: dt.date | str,
                  part_col: str = "day") -> None:
    """SNK-2: replace the days ``first..last`` with ``df``'s rows for those days; other days stay.

    Window days present in ``df`` are replaced by a dynamic partition overwrite; window days absent from
    ``df`` are emptied first, as the source's delete-then-insert does. ``df`` is evaluated once (checkpointed).
    Re-running is idempotent; after a crash in between, the reload must be run again.
    """
    first_d = dt.date.fromisoformat(str(first))
    last_d = dt.date.fromisoformat(str(last))
    in_window = F.col(part_col).between(F.lit(str(first_d)).cast("date"), F.lit(str(last_d)).cast("date"))
    # The new rows are computed once: checkpointed in the shared folder, then both listed (which window days
    # received rows: a handful of dates) and written, instead of running the upstream job twice.
    shared_dir(spark)
    window = conform(df.filter(in_window), target.contract, cast_present="strict").checkpoint(eager=True)
    written = {r[0] for r in window.select(part_col).distinct().collect()}
    for day in sorted(_days_present(spark, target, part_col, first_d, last_d) - written):
        empty_partition(spark, target, {part_col: day.isoformat()})
    overwrite_partitions(spark, window, target)


def _days_present(spark: SparkSession, target: Target, part_col: str, first: dt.date, last: dt.date) -> set[dt.date]:
    """Which days from ``first`` to ``last`` have rows (partition pruning: other days' files are not read)."""
    window = F.col(part_col).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return {r[0] for r in _stored(spark, target).filter(window).select(part_col).distinct().collect()}


def _stored(spark: SparkSession, target: Target) -> DataFrame:
    """The table's rows; none if its folder does not exist yet. Any other failure to read is raised."""
    from pyspark.errors import AnalysisException

    try:
        return read(spark, target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], target.schema)


def upsert_latest(spark: SparkSession, df: DataFrame, target: Target, key: Sequence[str], version: str) -> None:
    """SNK-3: versioned upsert, latest ``version`` wins per key (replacing-merge semantics).

    Only partitions that receive new rows are touched: their current rows are read (only those partitions' files),
    unioned with the batch, reduced to the latest version per key (which also removes duplicates inside the batch),
    checkpointed, then written back with a dynamic partition overwrite. The key must determine the partition columns, so every version of a key
    lives in one partition.
    """
    shared_dir(spark)
    # The batch is evaluated once: its partition values and the merge both read the checkpoint.
    new = conform(df, target.contract, cast_present="strict").checkpoint(eager=True)
    merged = latest_version(_touched(spark, target, new).unionByName(new), key, version)
    # The overwrite deletes files that the merge reads: cut the lineage first.
    overwrite_partitions(spark, merged.checkpoint(eager=True), target)


def _touched(spark: SparkSession, target: Target, new: DataFrame) -> DataFrame:
    """The stored rows in the partitions that ``new`` has rows for; other partitions' files are not read.

    The batch's partition values (a folder each, so as many as the write makes anyway) are broadcast to a semi join, whose values
    prune the scan's folders while it runs (dynamic partition pruning); none come to the driver. Values with a null in them
    join null-safely, after a plain filter to the folders that hold nulls.
    """
    stored, parts = _stored(spark, target), list(target.partition_by)
    if not parts:
        return stored
    known = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in parts])
    renamed = [F.col(f"`{c}`").alias(f"__t_{c}") for c in parts]
    # The filter on the count marks this side as selective, which is what makes the optimizer prune.
    values = new.groupBy(*[F.col(f"`{c}`") for c in parts]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 0")
    same = reduce(Column.__and__, [F.col(f"`{c}`") == F.col(f"__t_{c}") for c in parts])
    same_null = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"__t_{c}")) for c in parts])
    return (stored.join(F.broadcast(values.filter(known).select(*renamed)), same, "left_semi")
            .unionByName(stored.filter(~known).join(F.broadcast(values.filter(~known).select(*renamed)), same_null, "left_semi")))


def backfill_with_default(spark: SparkSession, source: DataFrame, target: Target, day_col: str,
                          last_day: dt.date | str, defaults: dict) -> None:
    """SNK-4: copy rows up to the end of ``last_day`` into ``target`` with constant new columns, bound by
    name (the source statement relied on position, which silently swaps same-typed columns)."""
    bound = F.lit(f"{last_day} 23:59:59").cast("timestamp_ntz")
    rows = source.filter(F.col(day_col).cast("timestamp_ntz") <= bound)
    append(spark, rows.withColumns({k: F.lit(v) for k, v in defaults.items()}), target)


def truncate(spark: SparkSession, target: Target) -> None:
    """SNK-5: empty the table, keeping its schema."""
    empty = spark.createDataFrame([], target.schema)
    _writer(empty, target, "overwrite").parquet(target.path)


def export_csv(df: DataFrame, path: str) -> None:
    """SNK-7 / SNK-9: header CSV export (spreadsheets re-aimed as CSV)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def dump_json(df: DataFrame, path: str) -> None:
    """SNK-10: raw JSON lines; Spark writes UTF-8 and does not escape non-ASCII text."""
    df.write.mode("overwrite").json(path)

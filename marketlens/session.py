"""Spark session settings and the shared folder for written intermediates.

The library itself never creates a session inside an operator; jobs receive one. ``build_session`` is for
scripts, tests and the bench. ``shared_dir`` is where jobs put tables they must write and read back
(window reload, upsert staging): it is the cluster's ``spark.checkpoint.dir``; only when that is unset in
local mode (a laptop or a test) do we pick a local folder ourselves; on a cluster an unset one is an error.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings every job assumes. ANSI stays on (Spark 4 default): landed text is cast with try_cast.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE: coalesce small shuffle partitions, split skewed join partitions, switch a join to broadcast
    # when the measured (not estimated) build side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static plan-time broadcast only below 32 MB of estimated size; AQE re-checks with runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # Rows of whole documents go to Python in small batches: a batch is held by the JVM and by the worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Checkpoints written by reload/upsert are deleted once their DataFrames are garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster, pass ``master=None`` and let spark-submit decide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the jobs rely on (strict writes need ANSI casts); safe to call on a session someone else built."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled",
              "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.set(k, BASE_CONF[k])


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); set a local one only when it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                           "(a machine-local folder is not visible to executors and is lost with the driver)")
    local = tempfile.mkdtemp(prefix="marketlens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


ADVISORY, COALESCE = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled"


@contextmanager
def spread_small(df: DataFrame) -> Iterator[None]:
    """While it lasts, a REBALANCE of a frame too small to give every core a partition of the advisory size (64 MB) is not drawn together into a
    few tasks: these would write many small folders one after the other. Large partitions are split by size either way."""
    spark = df.sparkSession
    known = spark.conf.get(ADVISORY, "64m")
    full = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(known)) * spark.sparkContext.defaultParallelism
    before = spark.conf.get(COALESCE)
    small = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < full
    if small:
        spark.conf.set(COALESCE, "false")
    try:
        yield
    finally:
        if small:
            spark.conf.set(COALESCE, before)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder for one written table; ``drop_scratch`` removes them."""
    path = os.path.join(shared_dir(spark), "marketlens", f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this process has written to scratch locations so far. Call it when no DataFrame that reads them is used any more."""
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, where neither PYTHONPATH nor the working folder already gives it to them.

    Jobs submitted with ``--py-files`` or an installed package need no such call.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    local = spark.sparkContext.master.split("[")[0] == "local"
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or (local and os.path.abspath(os.getcwd()) == root):
        return
    if any(os.path.basename(p) == f"{name}.zip" for p in getattr(spark.sparkContext, "_python_includes", [])):
        return
    folder = tempfile.mkdtemp(prefix="marketlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # tasks fetch the file when they first run
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))

"""Incremental order log (JOB-11) as a Structured Streaming job.

The batch job finds new rows with a high-water mark. As a stream, the file source itself remembers which
landed files it has processed (in the checkpoint), so each landed page is read exactly once, and
``trigger(availableNow=True)`` turns the stream into a catch-up run that stops when nothing is left, to
be scheduled like the daily batch. Each micro-batch goes through the same typed preparation and the
latest-version upsert; the upsert is idempotent, so a micro-batch replayed after a failure leaves the same
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.orders import prepare_orders
from ..schemas import ORDERS_WB_KEY, ORDERS_WB_VERSION, SUPPLIER_ORDERS
from ..sinks import writers


def orders_stream(spark: SparkSession, landed_dir: str, target: writers.Target, checkpoint_location: str,
                  project: str | None = None, max_files_per_trigger: int = 1000, multi_line: bool = True) -> StreamingQuery:
    """A file is a page as ``sources.landed.read_landed`` reads it (``multi_line``); a page that does not parse stops the run. Start a catch-up run over new landed order files; returns the query (call ``awaitTermination``)."""
    source = (spark.readStream.schema(SUPPLIER_ORDERS)
              .option("multiLine", multi_line).option("mode", "FAILFAST")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .json(landed_dir))

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = prepare_orders(batch, project).withColumn("day", F.to_date("date"))
        writers.upsert_latest(batch.sparkSession, rows, target, ORDERS_WB_KEY, ORDERS_WB_VERSION)

    return (source.writeStream.foreachBatch(upsert_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())

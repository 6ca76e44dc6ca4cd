"""The periodic headline job as an incremental Structured Streaming query.

New headline files land in a source directory; each micro-batch is linked to
the master (J1) and appended to the fact store, skipping articles already
stored. The store's manifest records each batch's epoch under the checkpoint's
path in the same commit as its rows: a micro-batch replayed after a failure
between that commit and the checkpoint's is known without reading anything, and
one whose write was left half finished shows none of it and is written again.
The anti-join on the article id covers articles that another run stored, so
results do not depend on batch boundaries. Progress lives in the checkpoint
directory (a shared folder), so a restarted driver resumes where it stopped;
``trigger(availableNow=True)`` processes what is there and stops (an hourly
schedule is ``processingTime='1 hour'``).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store
from ..operators.linking import link_headlines
from ..session import stored

SINK_COLUMNS = ["seq", "run_date", "code", "name", "content"]
SINK_SCHEMA = "seq bigint, code string, name string, content string, run_date string"


def stored_ids(spark: SparkSession, sink_root: str, days: list[str], version: store.Snapshot) -> DataFrame:
    """Ids stored for the given days: only those partitions are listed and read."""
    return store.read_store(spark, sink_root, columns=["seq"], schema=SINK_SCHEMA, partitions={"run_date": days}, version=version)


def process_batch(batch: DataFrame, epoch: tuple[str, int], master: DataFrame, sink_root: str,
                  to_headlines: Callable[[DataFrame], DataFrame], before_publish=None) -> None:
    spark = batch.sparkSession
    now = store.snapshot(spark, sink_root)
    if store.seen(now, epoch):
        return
    linked = stored(link_headlines(to_headlines(batch), master).select(
        "seq", F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "code", "name", "content"), "stream-batch")
    days = [r[0] for r in linked.select("run_date").distinct().collect()]  # a few days per batch
    fresh = linked.join(stored_ids(spark, sink_root, days, now), "seq", "left_anti")
    store.append(fresh.select("seq", "code", "name", "content", "run_date"), sink_root,
                 partition_by=["run_date"], epoch=epoch, before_publish=before_publish)


def incremental(spark: SparkSession, src_dir: str, src_schema, master: DataFrame, sink_root: str,
                checkpoint_dir: str, to_headlines: Callable[[DataFrame], DataFrame],
                max_files_per_trigger: int | None = None) -> None:
    """Run the incremental job over everything currently in ``src_dir``, in one batch unless
    a rate is given."""
    reader = spark.readStream.schema(src_schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(src_dir)
    q = (stream.writeStream
         .foreachBatch(lambda df, n: process_batch(df, (checkpoint_dir, n), master, sink_root, to_headlines))
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()

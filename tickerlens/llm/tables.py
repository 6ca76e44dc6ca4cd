"""Intermediate tables in the shared folder."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tickerlens.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, and a
    lost executor costs only the stages after it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run: Callable) -> Callable:
    """``run`` of mapInArrow, whose memory goes back to the system when a task is done: Arrow's pool
    else keeps it in a worker that waits for later tasks, beside the executor's heap."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return task


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names`` for helper columns, each lengthened until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out

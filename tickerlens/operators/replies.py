"""A reply cache for the enrichment hook (U1): each distinct input is asked once, ever.

Replies live in a committed store (``operators.store``) with one row per asked input, keyed by
a digest of model name and input, in two partitions: ``kind=reply`` and ``kind=failure``. A run
takes the distinct inputs, leaves those that have a reply or have failed ``most_attempts`` times,
asks the rest, and stores what came in one commit; then it joins the replies back. A run that
dies before the commit stores nothing, and its inputs are asked again. An input that a third of
all rows share is one call, one stored row, and a join that AQE may split.
"""
from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_shipped, stored
from . import store

SCHEMA = "key string, input string, reply string, error string, attempt int, kind string"
ASKED = "key string, input string, attempt int"


def reply_key(text: Column, model: str) -> Column:
    return F.sha2(F.concat(F.lit(model), F.lit("\0"), text), 256)


def _rows(spark, root: str, kind: str) -> DataFrame:
    return store.read_store(spark, root, schema=SCHEMA, partitions={"kind": [kind]})


def ask(todo: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """The rows to store for ``todo`` (key, input, attempt): one call each; one that raises, or
    gives no text, is a failure with its error."""
    ensure_shipped(todo.sparkSession)

    def run(batches):
        for pdf in batches:
            out = []
            for key, text, attempt in zip(pdf["key"], pdf["input"], pdf["attempt"]):
                try:
                    reply, error = fn(text), None
                    if not isinstance(reply, str):
                        raise TypeError(f"no text: {type(reply).__name__}")
                except Exception as e:  # noqa: BLE001 - a failing call is a row, not a failing task
                    reply, error = None, f"{type(e).__name__}: {e}"[:500]
                out.append((key, text, reply, error, attempt, "reply" if error is None else "failure"))
            yield pd.DataFrame(out, columns=["key", "input", "reply", "error", "attempt", "kind"])
    return todo.mapInPandas(run, SCHEMA)


def enrich_cached(df: DataFrame, fn: Callable[[str], str], in_col: str, out_col: str, root: str, *, model: str = "",
                  fallback_col: str | None = None, fallback_value: str | None = None, most_attempts: int = 3) -> DataFrame:
    """``df`` with ``out_col``: the cached reply to ``in_col``, asked for now where there is none,
    else the fallback. A null input is never asked."""
    spark = df.sparkSession
    wanted = (df.where(F.col(in_col).isNotNull()).select(F.col(in_col).cast("string").alias("input")).distinct()
              .withColumn("key", reply_key(F.col("input"), model)))
    failed = _rows(spark, root, "failure").groupBy("key").agg(F.max("attempt").alias("tried"))
    todo = (wanted.join(_rows(spark, root, "reply").select("key"), "key", "left_anti").join(failed, "key", "left")
            .withColumn("attempt", F.coalesce("tried", F.lit(0)) + 1).where(F.col("attempt") <= most_attempts))
    todo = stored(todo.select("key", "input", "attempt"), "replies-todo")
    if todo.limit(1).count():
        store.append(ask(todo, fn), root, partition_by=["kind"])
    # two runs at the same time may both have asked: one reply of an input counts
    known = _rows(spark, root, "reply").groupBy("key").agg(F.min("reply").alias("_reply")).withColumnRenamed("key", "_key")
    fallback = F.col(fallback_col) if fallback_col else F.lit(fallback_value)
    met = df.join(known, reply_key(df[in_col].cast("string"), model) == known["_key"], "left")
    return met.select(*[df[c] for c in df.columns], F.coalesce(known["_reply"], fallback.cast("string")).alias(out_col))


def failures(spark, root: str) -> DataFrame:
    """The retry table: inputs without a reply, with attempts so far and the last error."""
    bad = _rows(spark, root, "failure").groupBy("key", "input").agg(F.max("attempt").alias("attempts"), F.max_by("error", "attempt").alias("error"))
    return bad.join(_rows(spark, root, "reply").select("key"), "key", "left_anti").select("input", "attempts", "error")

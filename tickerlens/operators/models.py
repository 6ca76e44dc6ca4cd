"""Stored bag-of-words models (A8, A9): fitted once, loaded by later runs.

A model is its vocabulary with counts and weights, at most ``features.VOCAB_SIZE`` rows in a
committed store, under the fingerprint of the labelled corpus it was fitted on: number of rows and
an exact sum of their hashes, whatever their order. A run that finds its corpus' fingerprint loads
the model; with another corpus, or a model made by other rules, it fits and stores a new one.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

SCHEMA = "term string, cnt long, weight double, fitted_on string"
#: Changes with the rules that turn a corpus into a model.
RULES = "letters-5000-sixteenths"


def fingerprint(corpus: DataFrame, columns: list[str]) -> str:
    """Of the rows of ``corpus``: one pass with partial aggregation."""
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]).cast("decimal(20,0)")
    row = corpus.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h")).first()
    return f"{RULES}-{row['n']}-{row['h'] or 0}"


def save_model(vocab: DataFrame, weights: DataFrame, root: str, fitted_on: str) -> None:
    rows = vocab.join(weights, vocab["token"] == weights["term"], "left").select(
        F.col("token").alias("term"), F.col("cnt"), "weight", F.lit(fitted_on).alias("fitted_on"))
    store.append(rows, root, partition_by=["fitted_on"])


def load_model(spark: SparkSession, root: str, fitted_on: str) -> tuple[DataFrame, DataFrame] | None:
    """(vocabulary, weights) of the model fitted on this corpus, None if none is stored. Of two
    runs that stored it at the same time the rows are equal."""
    if fitted_on not in store.partition_values(store.snapshot(spark, root), "fitted_on"):
        return None
    rows = store.read_store(spark, root, schema=SCHEMA, partitions={"fitted_on": [fitted_on]}).drop("fitted_on").distinct()
    return (rows.select(F.col("term").alias("token"), "cnt"), rows.where("weight IS NOT NULL").select("term", "weight"))


def model_for(corpus: DataFrame, root: str, fit: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
              columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The stored model of ``corpus``, which is fitted and stored first if there is none."""
    spark, key = corpus.sparkSession, fingerprint(corpus, columns)
    found = load_model(spark, root, key)
    if found is None:
        save_model(*fit(corpus), root, key)
        found = load_model(spark, root, key)
    return found


def log_loss(scored: DataFrame, score: str = "z", label: str = "label") -> DataFrame:
    """(n, loss): mean logistic loss of linear scores against 0/1 labels, six decimals."""
    z, y = F.col(score), F.col(label).cast("double")
    one = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(one), 6).alias("loss"))

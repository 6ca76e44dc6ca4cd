"""The corpus pipeline: from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
in the shared folder and reads it back as the next stage's documents. All stages but the last
return the columns of ``documents``:

* language_id drops documents whose language is unknown (no letters, or unlike all languages);
* near_dedup keeps one document of each group of near-duplicates (five-word shingles, 0.8);
* decontaminate drops documents that the benchmark contaminates;
* mix repeats or drops documents so that each source comes near its target;
* token_binary writes the token files and returns one row per document read back from them.

Cases: see the operators; an empty table passes through every stage as an empty table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerlens.llm import decontam, langid, mixing, neardup, token_store
from tickerlens.llm.tables import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_binary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.token_digests(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("token_binary", token_binary)]

# tokenizing, sketching and the schedule's hashed order are beyond DuckDB SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

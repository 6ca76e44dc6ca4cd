"""Bag-of-words features (A3 tokenise, A4 vocabulary, A5 term frequency, S6 cache)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import _fs

# Vocabulary size and the token rule (runs of letters, lower-cased).
VOCAB_SIZE = 5000
TOKEN_PATTERN = r"\p{L}+"


def tokenise(col) -> Column:
    """A3: lower-cased letter runs, in text order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def token_counts(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """(id, term, tf) over every token of every document (partial aggregation)."""
    return (docs.select(id_col, F.explode(tokens_col).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("bigint").alias("tf")))


def vocabulary(docs: DataFrame, tokens_col: str = "tokens", k: int = VOCAB_SIZE,
               counts: DataFrame | None = None) -> DataFrame:
    """A4: the k most frequent tokens over all documents (ties: token order).
    Partial counts per map task, one shuffle keyed by token, then a bounded
    top-k (TakeOrderedAndProject) - the limit is the operator itself. Given
    ``token_counts``, the documents are not tokenised again."""
    if counts is not None:
        totals = counts.groupBy(F.col("term").alias("token")).agg(F.sum("tf").alias("cnt"))
    else:
        totals = (docs.select(F.explode(tokens_col).alias("token"))
                  .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))
    return totals.orderBy(F.col("cnt").desc(), F.col("token")).limit(k)


def term_frequency(docs: DataFrame, vocab: DataFrame, id_col: str = "id",
                   tokens_col: str = "tokens", counts: DataFrame | None = None) -> DataFrame:
    """A5 (sparse): (id, term, tf) for vocabulary terms present in the document.
    The vocabulary is at most k rows by construction, so it is broadcast."""
    v = F.broadcast(vocab.select(F.col("token").alias("term")))
    if counts is not None:
        return counts.join(v, "term").select(id_col, "term", "tf")
    toks = docs.select(id_col, F.explode(tokens_col).alias("term"))
    return (toks.join(v, "term").groupBy(id_col, "term")
            .agg(F.count(F.lit(1)).cast("bigint").alias("tf")))


def term_occurrences(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """(id, term, tf = 1) for each token of each document: what a sum over terms needs, without
    the shuffle that counts them per document."""
    return docs.select(id_col, F.explode_outer(tokens_col).alias("term"), F.lit(1).cast("bigint").alias("tf"))


def cached_tokens(spark: SparkSession, docs: DataFrame, path: str, id_cols: list[str],
                  text_col: str, extra_cols: list[str] | None = None) -> DataFrame:
    """Tokenised corpus materialised once: read ``path`` if it holds a
    committed table, else compute, write, and read it back."""
    fs, p = _fs(spark, path)
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    if not fs.exists(done):
        (docs.select(*id_cols, *(extra_cols or []), tokenise(text_col).alias("tokens"))
         .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)

"""Driver tables -> domain tables.

The generated test tables are TPC-H-like, not news. These adapters derive the
job's domain tables from them deterministically (every row of the source is
used; values are derived, nothing is sampled). ``plans/oracle.py`` holds the
same derivations as DuckDB SQL so both engines see identical inputs.

  headlines   <- events     (one headline per event; lists of 10 per page slot)
  master      <- customer   (company name = c_name with '#' -> ' ', code = zero-padded key)
  quotes      <- lineitem   (one daily quote per line item, code = part key)
  store       <- events + documents (rows already analysed, with reports)
  replies     <- events     (model replies covering every verdict branch)
  corpus      <- documents + labels
  company     <- part       (rendered company pages, see ``company_pages``)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

# ---------------------------------------------------------------------------
# Fixed adapter values (the oracle SQL uses the same literals)
# ---------------------------------------------------------------------------
# Tone suffix of a headline, by event type.
TONE = {
    "purchase": " 긍정 전망",
    "error": " negative outlook",
    "signup": " positive and negative",
    "click": " 부정 이슈",
}
TONE_DEFAULT = " steady-state"
# Model replies, picked by event_id % 13 (the verdict hand cases, plus one
# taken from the headline itself).
REPLIES = [
    "긍정문입니다",
    "이 문장은 부정문입니다",
    "부정문입니다",
    "긍정도 부정도 아님",
    "사실을 말함",
    "It is a negative sentence.",
    "negative",
    "Negative.",
    "It is a positive sentence",
    "a statement, negative",
    "한국 negative",
    "こんにちは",
]
# Stored report variants, by doc_id % 5: 0 -> text + ' Error', 1 -> the Korean
# failure text, 2 -> text + ' 에러 발생', 3/4 -> text unchanged.
FAILURE_TEXT = "에러가 발생 했습니다"
# ---------------------------------------------------------------------------


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headlines_from_events(read_table(spark, sf_dir, "events"))


def headlines_from_events(e: DataFrame) -> DataFrame:
    """Per-row derivation (also applied to each streaming micro-batch)."""
    eid = F.col("event_id")
    key_part = (F.when(eid % 7 == 0, F.lit("Customer"))
                .when(eid % 11 == 0, F.concat(F.lit("Client "), F.col("user_id").cast("string")))
                .otherwise(F.concat(F.lit("Customer "), F.lpad(F.col("user_id").cast("string"), 9, "0"))))
    ticker = F.when(eid % 3 == 0, F.concat(
        F.lit(" ("), F.upper(F.expr("substring(event_type, 1, cast(1 + event_id % 6 as int))")),
        F.lit(")"))).otherwise(F.lit(""))
    tone = F.lit(TONE_DEFAULT)
    for k, v in reversed(TONE.items()):
        tone = F.when(F.col("event_type") == k, F.lit(v)).otherwise(tone)
    return e.select(
        eid.alias("seq"),
        F.to_date("ts").alias("run_date"),
        F.expr("event_id div 20").alias("page_no"),
        F.when(eid % 20 < 10, F.lit("dd")).otherwise(F.lit("dt")).alias("slot"),
        (eid % 10).alias("pos"),
        F.concat(key_part, F.lit(", "), F.col("event_type"), F.lit("-"),
                 F.col("user_id").cast("string"), ticker, tone).alias("title"),
        "ts", "user_id", "event_type",
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.linking import stock_master
    c = read_table(spark, sf_dir, "customer").withColumn(
        "c_name", F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")))
    return stock_master(c, "c_name", "c_custkey", "c_custkey")


def six_digits(key):
    """``format_string('%06d', key)``, without a formatter for the keys that are plain numbers."""
    t = key.cast("string")
    return (F.when((key >= 0) & (key < 1000000), F.lpad(t, 6, "0")).when(key >= 1000000, t)
            .otherwise(F.format_string("%06d", key)))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    return li.select(
        six_digits(F.col("l_partkey")).alias("code"),
        F.col("l_shipdate").alias("date"),
        p.cast("bigint").alias("close"),
        q.cast("bigint").alias("diff"),
        (p * (1 - F.col("l_discount"))).cast("bigint").alias("open"),
        (p * (1 + F.col("l_tax"))).cast("bigint").alias("high"),
        (p * (1 - F.col("l_discount") - F.col("l_tax"))).cast("bigint").alias("low"),
        # a seventh line has no volume: an incomplete quote, which the job drops
        F.when(F.col("l_linenumber") != 7, (q * F.col("l_linenumber")).cast("bigint")).alias("volume"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


QUOTE_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fact already analysed when a job runs: purchase and view events."""
    return _stored(spark, sf_dir, read_table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "view")))


def store_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact: a row per event."""
    return _stored(spark, sf_dir, read_table(spark, sf_dir, "events"))


def _stored(spark: SparkSession, sf_dir: str, e: DataFrame) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    j = e.join(d, e["event_id"] == d["doc_id"], "left")
    m = F.col("doc_id") % 5
    report = (F.when(F.col("doc_id").isNull(), F.lit(None).cast("string"))
              .when(m == 0, F.concat(F.col("text"), F.lit(" Error")))
              .when(m == 1, F.lit(FAILURE_TEXT))
              .when(m == 2, F.concat(F.col("text"), F.lit(" 에러 발생")))
              .otherwise(F.col("text")))
    return j.select(
        F.col("event_id").alias("seq"),
        F.format_string("%06d", F.col("user_id")).alias("code_"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_"),
        report.alias("report_"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reply per headline event; index 12 replies with the title itself."""
    h = headlines(spark, sf_dir)
    arr = F.array(*[F.lit(r) for r in REPLIES])
    idx = (F.col("seq") % 13).cast("int")
    return h.select("seq", "title",
                    F.when(idx < len(REPLIES), F.get(arr, idx)).otherwise(F.col("title")).alias("reply"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled review corpus (id, document, label) from documents x labels."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("id"),
                                        F.col("text").alias("document"),
                                        F.col("quality").alias("label"))


# --- US branch --------------------------------------------------------------
# Ticker symbol of a customer: 'T' + key % 1000 (2-4 characters); every 7th
# customer carries a long symbol 'TX' + key, which the ticker rule drops.
def _symbol(key):
    return (F.when(key % 7 == 0, F.concat(F.lit("TX"), key.cast("string")))
            .otherwise(F.concat(F.lit("T"), (key % 1000).cast("string"))))


def us_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """US headlines from orders; pending orders carry no ticker in parentheses."""
    o = read_table(spark, sf_dir, "orders")
    tick = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.concat(F.lit(" ("), _symbol(F.col("o_custkey")), F.lit(")")))
    return o.select(F.col("o_orderkey").alias("seq"), F.to_date("o_orderdate").alias("run_date"),
                    F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" update"), tick,
                             F.lit(" "), F.col("o_orderpriority")).alias("headline"))


def us_company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select((F.concat(F.lit("T"), (F.col("c_custkey") % 1000).cast("string"))).alias("ticker"),
                    F.concat(F.lit('<div><span class="symbol-page-header__name"> '), F.col("c_name"),
                             F.lit("\n</span></div>")).alias("html"))


def us_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """US rows already analysed: urgent orders, with stored reports."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    m = F.col("o_orderkey") % 4
    report = (F.when(m == 0, F.concat(F.lit("summary "), F.col("o_orderkey").cast("string")))
              .when(m == 1, F.lit(FAILURE_TEXT))
              .when(m == 2, F.concat(F.lit("Error "), F.col("o_orderkey").cast("string"))))
    return o.select(_symbol(F.col("o_custkey")).alias("ticker"),
                    F.date_format("o_orderdate", "yyyyMMdd").alias("date_"), report.alias("report_"))

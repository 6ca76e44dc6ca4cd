"""Linking headlines to listed companies.

* J1 is an equi-join on the cleaned headline key against a master deduplicated
  by name (last row wins) - broadcast only after a bounded count.
* J2 (which names *contain* the key) is answered without a nested loop: every
  distinct substring of every master name becomes an index row, and the distinct
  headline keys equi-join that index. Work is linear in (names x name length)
  plus distinct keys, never headlines x names.
* J3 (legacy carry-forward of the previous linked code) is a chunked prefix
  scan: per-chunk last value -> carry across chunk summaries -> within-chunk
  window. No window ever holds more than one chunk of one run.
* J4 is a single left-anti join against the stored fact.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import headline_key, strip_hyphen
from ..session import spread


def stock_master(listing: DataFrame, name_col: str, code_col: str,
                 order_col: str | None = None) -> DataFrame:
    """Keep name and code, zero-pad code to six digits (never truncates)."""
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    return listing.select(F.col(name_col).cast("string").alias("name"),
                          F.format_string("%06d", F.col(code_col).cast("bigint")).alias("code"),
                          order.cast("bigint").alias("row_no"))


def dedupe_master(master: DataFrame) -> DataFrame:
    """Several equal names -> the last master row wins (partial aggregation)."""
    return master.groupBy("name").agg(F.max_by("code", "row_no").alias("code"))


def link_headlines(headlines: DataFrame, master: DataFrame, title_col: str = "title") -> DataFrame:
    """J1 (+P2, P3): inner equi-join of the headline key on the (raw) company name.
    Adds key, code, name, content (title without '-')."""
    m = dedupe_master(master)  # small after aggregation: AQE broadcasts it at runtime
    h = headlines.withColumn("key", headline_key(title_col))
    return (h.join(m, h["key"] == m["name"], "inner")
            .withColumn("content", strip_hyphen(title_col)))


def name_substring_index(master: DataFrame, lengths: list[int] | None = None, rows: int = 0) -> DataFrame:
    """(sub, n_names): for every non-empty substring (of the given lengths only,
    when ``lengths`` is set), how many distinct names hold it. ``rows``: names there may be."""
    # the names are dealt out first, so that no task holds the substrings of all of them; a
    # substring that a name holds twice is counted where it starts first
    names = spread(master.select("name").where(F.col("name").isNotNull()).distinct(), rows)
    n = F.length("name")
    if lengths is not None:
        ln = F.explode(F.array(*[F.lit(int(x)) for x in lengths] or [F.lit(0)]))
        spans = names.withColumn("_l", ln).where((F.col("_l") > 0) & (F.col("_l") <= n))
        spans = spans.withColumn("s", F.explode(F.sequence(F.lit(1), n - F.col("_l") + 1)))
        subs = spans.select("name", "s", F.substring("name", F.col("s"), F.col("_l")).alias("sub"))
    else:
        subs = (names.where(n > 0)
                .withColumn("s", F.explode(F.sequence(F.lit(1), n)))
                .withColumn("e", F.explode(F.sequence(F.col("s"), n)))
                .select("name", "s", F.substring("name", F.col("s"), F.col("e") - F.col("s") + 1).alias("sub")))
    return subs.where(F.instr("name", F.col("sub")) == F.col("s")).groupBy("sub").agg(F.count(F.lit(1)).alias("n_names"))


def candidate_counts(keys: DataFrame, master: DataFrame, key_col: str = "key") -> DataFrame:
    """For each distinct key, the number of master names containing it
    (literal substring; the empty key is contained in every name). Only name
    substrings whose length equals some key length are indexed; the distinct
    key lengths are few (bounded by the longest name) and are read first."""
    total = master.select(F.count_distinct("name")).scalar()
    dk = keys.select(key_col).where(F.col(key_col).isNotNull()).distinct()
    max_name, n_names = master.select(F.coalesce(F.max(F.length("name")), F.lit(0)), F.count("name")).first()
    lengths = [r[0] for r in dk.select(F.length(key_col).alias("l")).distinct()
               .where((F.col("l") > 0) & (F.col("l") <= max_name)).collect()]  # <= max_name values
    idx = name_substring_index(master, lengths, n_names)
    j = dk.join(idx, dk[key_col] == idx["sub"], "left")
    return j.select(key_col, F.when(F.col(key_col) == "", total)
                    .otherwise(F.coalesce(F.col("n_names"), F.lit(0)))
                    .cast("bigint").alias("n_candidates"))


def carry_forward(df: DataFrame, value_cols: list[str], run_col: str, order_col: str,
                  chunk_rows: int = 1 << 20) -> DataFrame:
    """Last non-null ``value_cols`` (as a unit) at or before each row, per run,
    in ``order_col`` order. ``order_col`` must be an integral sequence; rows are
    cut into chunks of ``chunk_rows`` consecutive sequence values."""
    val = F.struct(*[F.col(c) for c in value_cols])
    has = F.col(value_cols[0]).isNotNull()
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk_rows)).cast("bigint"))
    summ = (d.groupBy(run_col, "_chunk")
            .agg(F.max_by(F.when(has, val), F.when(has, F.col(order_col))).alias("_last")))
    w_chunks = (Window.partitionBy(run_col).orderBy("_chunk")
                .rowsBetween(Window.unboundedPreceding, -1))
    carry_in = summ.select(run_col, "_chunk",
                           F.last("_last", ignorenulls=True).over(w_chunks).alias("_carry_in"))
    w_rows = (Window.partitionBy(run_col, "_chunk").orderBy(order_col)
              .rowsBetween(Window.unboundedPreceding, 0))
    within = d.withColumn("_within", F.last(F.when(has, val), ignorenulls=True).over(w_rows))
    out = within.join(carry_in, [run_col, "_chunk"], "left")
    res = F.coalesce(F.col("_within"), F.col("_carry_in"))
    for c in value_cols:
        out = out.withColumn(f"{c}_carried", res[c])
    return out.drop("_chunk", "_within", "_carry_in")


def link_with_legacy_carry(headlines: DataFrame, master: DataFrame, run_col: str = "run_date",
                           order_col: str = "seq", title_col: str = "title",
                           chunk_rows: int = 1 << 20) -> DataFrame:
    """Headlines whose key is contained in some name (J2) are linked; those
    without an exact (J1) match take the code and name of the previous exactly
    linked headline of the same run ('' when there is none)."""
    m = dedupe_master(master)
    h = headlines.withColumn("key", headline_key(title_col))
    cand = candidate_counts(h, master)
    h = h.join(cand, "key", "left")
    h = h.join(m, h["key"] == m["name"], "left")
    carried = carry_forward(h, ["code", "name"], run_col, order_col, chunk_rows)
    return (carried.where(F.col("n_candidates") > 0)
            .select(*headlines.columns, "key",
                    F.coalesce("code_carried", F.lit("")).alias("code"),
                    F.coalesce("name_carried", F.lit("")).alias("name"),
                    F.col("code").isNotNull().alias("exact"),
                    strip_hyphen(title_col).alias("content")))


def new_only(df: DataFrame, store: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Drop rows already present in the store, matched on (df col, store col)
    pairs. A single left-anti join replaces one exists-query per item; the store
    side is first reduced to its distinct keys (partial aggregation), so a key
    stored many times is one row on the build side."""
    sk = store.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys)]).distinct()
    cond = None
    for i, (a, _) in enumerate(keys):
        c = df[a] == sk[f"_k{i}"]
        cond = c if cond is None else cond & c
    return df.join(sk, cond, "left_anti")

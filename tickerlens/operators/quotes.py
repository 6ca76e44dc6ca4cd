"""Quotes and period series (W1 latest quote, J8 attach quote, A6 last valid)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

QUOTE_VALUES = ["close", "diff", "open", "high", "low", "volume"]


def latest_quote(quotes: DataFrame, code_col: str = "code", date_col: str = "date",
                 tiebreak: list[str] | None = None) -> DataFrame:
    """Newest row per code. ``max_by`` over (date, tiebreak..., values) is a
    partial aggregation: one shuffle of one small struct per code and map task,
    even when one code holds a third of the rows. A row with a null date or value is
    dropped before, so an older whole row can be the newest."""
    vals = F.struct(F.col(date_col).alias("date"), *[F.col(c) for c in QUOTE_VALUES])
    order = F.struct(F.col(date_col), *[F.col(c) for c in (tiebreak or [])],
                     *[F.col(c) for c in QUOTE_VALUES])
    return (quotes.dropna(subset=[date_col, *QUOTE_VALUES])
            .groupBy(F.col(code_col).alias("code"))
            .agg(F.max_by(vals, order).alias("_q"))
            .select("code", *[F.col("_q")[c].alias(c) for c in ["date"] + QUOTE_VALUES]))


def attach_quote(df: DataFrame, latest: DataFrame, code_col: str = "code") -> DataFrame:
    """J8 + P20: left join of the latest quote; a missing quote or a 0/None value -> 0."""
    q = latest.select(F.col("code").alias("_qcode"), *QUOTE_VALUES)
    out = df.join(q, df[code_col] == q["_qcode"], "left").drop("_qcode")
    for c in QUOTE_VALUES:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    return out


def last_valid(df: DataFrame, key_cols: list[str], period_col: str, value_col: str,
               out_col: str = "last_value") -> DataFrame:
    """Per key, the value of the latest period that is neither null nor NaN;
    0.0 when there is none. Ties on period resolve to the larger value."""
    ok = F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col))
    v = F.when(ok, F.col(value_col))
    return (df.groupBy(*key_cols)
            .agg(F.max_by(v, F.when(ok, F.struct(F.col(period_col), F.col(value_col)))).alias(out_col))
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(0.0))))


def last_valid_in(values) -> "F.Column":
    """A6 on an in-row array of period values (oldest first): last non-null,
    non-NaN element, else 0.0."""
    arr = F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x))
    return F.coalesce(let(arr, lambda a: F.get(a, F.size(a) - 1)), F.lit(0.0))

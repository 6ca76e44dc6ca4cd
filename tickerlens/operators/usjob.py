"""US branch operators: ticker extraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_paren, ticker_of

# Fixed value: tickers longer than this are dropped.
MAX_TICKER_LEN = 4


def extract_ticker(df: DataFrame, col: str = "headline", out_col: str = "ticker") -> DataFrame:
    """Text between the first '(' and the next ')' (or the end). No '(' ->
    dropped; longer than 4 characters -> dropped. No letter test."""
    return (df.where(has_paren(col)).withColumn(out_col, ticker_of(col))
            .where(F.length(out_col) <= MAX_TICKER_LEN))

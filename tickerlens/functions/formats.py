"""Run keys and date/time renderings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_keys(df: DataFrame, run_ts, code_col: str = "code") -> DataFrame:
    """Fact key = YYYYMMDD + HHMM + code (run time, so repeated codes within
    one run collide by design), detail key = YYYYMMDD + code, date_ YYYY-MM-DD,
    time_ HH:MM. ``run_ts`` is a timestamp column or literal."""
    ts = _c(run_ts) if not isinstance(run_ts, str) or run_ts in df.columns else F.lit(run_ts).cast("timestamp")
    day = F.date_format(ts, "yyyyMMdd")
    return (df.withColumn("key_", F.concat(day, F.date_format(ts, "HHmm"), F.col(code_col)))
              .withColumn("detail_key", F.concat(day, F.col(code_col)))
              .withColumn("date_", F.date_format(ts, "yyyy-MM-dd"))
              .withColumn("time_", F.date_format(ts, "HH:mm")))

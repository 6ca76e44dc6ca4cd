"""The crawl work list (dates x list pages x slots)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: list pages fetched per day (pages 1..9).
PAGES_PER_DAY = 9


def crawl_plan(dates: DataFrame, date_col: str = "run_date", pages: int = PAGES_PER_DAY,
               slots: tuple[str, ...] | None = None) -> DataFrame:
    """Every distinct date x page 1..pages (x slot when given). The explode of a
    fixed small sequence replaces a cross join."""
    out = (dates.select(date_col).where(F.col(date_col).isNotNull()).distinct()
           .withColumn("page_no", F.explode(F.sequence(F.lit(1), F.lit(pages)))))
    if slots:
        out = out.withColumn("slot", F.explode(F.array(*[F.lit(s) for s in slots])))
    return out

from pyspark.sql import functions as F

from tickerlens.operators.pages import backfill_horizon, dedupe_pages
from tickerlens.sources.crawl import crawl_plan


def test_dedupe_whole_lists_first_seen(spark):
    items = [("d", 1, "dd", 0, "a"), ("d", 1, "dd", 1, "b"), ("d", 1, "dt", 0, "a"),
             ("d", 2, "dd", 0, "a"), ("d", 2, "dd", 1, "b"), ("d", 2, "dt", 0, "b"), ("d", 2, "dt", 1, "a")]
    df = spark.createDataFrame(items, "run_date string, page_no int, slot string, pos int, title string")
    plan = spark.createDataFrame([("d", 1, "dd"), ("d", 1, "dt"), ("d", 2, "dd"), ("d", 2, "dt"),
                                  ("d", 3, "dd"), ("d", 3, "dt")], "run_date string, page_no int, slot string")
    _, kept = dedupe_pages(df, ["run_date", "page_no", "slot"], [F.col("page_no"), F.col("slot")],
                           all_lists=plan, run_cols=["run_date"])
    got = sorted((r.page_no, r.slot) for r in kept.collect())
    # (2, dd) repeats (1, dd); the two empty lists on page 3 count once
    assert got == [(1, "dd"), (1, "dt"), (2, "dt"), (3, "dd")]


def test_backfill_keeps_whole_days(spark):
    items = []
    for day, n in [("2024-01-04", 4), ("2024-01-03", 5), ("2024-01-02", 3), ("2024-01-01", 7)]:
        for p in range(n):
            items.append((day, p, "dd", 0, f"{day}-{p}"))
    df = spark.createDataFrame(items, "run_date string, page_no int, slot string, pos int, title string")
    got = sorted((r.run_date, r.lists_held) for r in
                 backfill_horizon(df, ["run_date", "page_no", "slot"], min_lists=10).collect())
    assert got == [("2024-01-02", 12), ("2024-01-03", 9), ("2024-01-04", 4)]


def test_crawl_plan(spark):
    d = spark.createDataFrame([("x",), ("x",), ("y",)], "run_date string")
    assert crawl_plan(d, slots=("dd", "dt")).count() == 2 * 9 * 2

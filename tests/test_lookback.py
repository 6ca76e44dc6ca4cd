"""W2 as part of a run: days are read newest first and no further than the horizon."""
from pyspark.sql import functions as F

from tickerlens.operators import enrich as EN
from tickerlens.operators import store as ST
from tickerlens.plans import jobs as J
from tickerlens.session import scratch_path

SCHEMA = "seq long, page_no long, slot string, pos long, title string, run_date string"


def stored_days(spark, lists):
    """lists: (day, page, [titles])"""
    rows, seq = [], 0
    for day, page, titles in lists:
        for pos, t in enumerate(titles):
            rows.append((seq, page, "dd", pos, t, day))
            seq += 1
    root = scratch_path(spark, "look-back")
    ST.append(spark.createDataFrame(rows, SCHEMA), root, ["run_date"])
    return root


def days_read(df):
    return {part.split("run_date=")[1].split("/")[0] for part in df.inputFiles()}


def test_reads_no_day_beyond_the_horizon(spark):
    lists = [(f"2024-01-{d:02}", p, [f"{d} {p} a", f"{d} {p} b"]) for d in range(1, 21) for p in range(3)]
    root = stored_days(spark, lists)
    got = J.look_back_headlines(spark, root, SCHEMA, min_lists=10)
    assert days_read(got) == {"2024-01-20", "2024-01-19", "2024-01-18", "2024-01-17"}  # 3, 6, 9, 12 lists
    assert {str(r.run_date) for r in got.collect()} == {"2024-01-20"} and got.count() == 24
    old = J.look_back_headlines(spark, root, SCHEMA, run_day="2024-01-02", min_lists=10)
    assert days_read(old) == {"2024-01-02", "2024-01-01"}  # the days end first
    assert {str(r.list_date) for r in old.collect()} == {"2024-01-02", "2024-01-01"}


def test_equal_lists_count_once_and_the_newest_stays(spark):
    same = ["same a", "same b"]
    root = stored_days(spark, [("2024-01-03", 0, same), ("2024-01-02", 0, same), ("2024-01-02", 1, ["x"]), ("2024-01-01", 5, ["y"])])
    items = J.look_back_headlines(spark, root, SCHEMA, min_lists=3)
    kept = J._select_headlines(items)
    assert sorted((str(r.list_date), r.title) for r in kept.collect()) == [
        ("2024-01-01", "y"), ("2024-01-02", "x"), ("2024-01-03", "same a"), ("2024-01-03", "same b")]
    assert J.look_back_headlines(spark, root, SCHEMA, min_lists=1).count() == 2


def test_empty_store(spark):
    assert J.look_back_headlines(spark, scratch_path(spark, "none"), SCHEMA).count() == 0


def test_company_request(spark):
    page = "<div class='tab um_bssummary'><h3> s </h3><ul><li class=a>동사는 o</li><li>p</li></ul></div>"
    df = spark.createDataFrame([("n", page), ("n", "<div class=um_bssummary></div>"), ("n", "<div class=\"um_bssummary\"><li>o</li></div>")], "name string, html string")
    got = [r[0] for r in df.select(EN.company_request(F.col("name"), F.col("html"))).collect()]
    head = "Please summarize the following text using bullet points:\n\n 기업명 : n\n\n 기업개요 : "
    assert got == [head + "<li class=a> o</li>\n\n 현재상황 : <h3> s </h3>", None, head + "<li>o</li>\n\n 현재상황 : None"]

"""Joins on the codes of a run's articles: by broadcast while they are few, and the same rows otherwise."""
import datetime

import pytest
from pyspark.sql import functions as F

from tickerlens import session
from tickerlens.plans import adapters as A
from tickerlens.plans import jobs as J

TABLE = "<table><tr><th>a</th><th>b</th></tr>" + "<tr><td>x</td><td>1,234</td></tr>" * 8 + "</table>"


@pytest.fixture
def unhinted(spark):
    """Broadcast only where a hint asks for it, as with tables too large for the threshold."""
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _details(spark):
    fact = spark.createDataFrame([("202401011800000001", "000001"), ("202401011800000003", "000003"), ("x", None)], "key_ string, code_ string")
    pages = spark.createDataFrame([("000001", TABLE * 11), ("000002", TABLE), (None, TABLE)], "code string, html string")
    rate = spark.createDataFrame([(10, "5\ub144", "8.5")], "row_no long, header string, cell string")
    return J.details(fact, pages, rate, materialized=True)


def _light(spark):
    day = datetime.date(2024, 1, 1)
    headlines = spark.createDataFrame([(1, day, 0, "dd", 0, "Acme, up"), (2, day, 0, "dd", 1, "Other, up"), (3, day, 0, "dd", 2, "Gone, up")],
                                      "seq long, run_date date, page_no long, slot string, pos long, title string")
    master = spark.createDataFrame([("Acme", "000001", 1), ("Other", None, 2)], "name string, code string, row_no long")
    store = spark.createDataFrame([], "code_ string, date_ string, report_ string")
    quotes = spark.createDataFrame([("000001", day, 5, 1, 2, 3, 4, 6), ("000009", day, 7, 1, 2, 3, 4, 6), (None, day, 8, 1, 2, 3, 4, 6)],
                                   "code string, date date, close long, diff long, open long, high long, low long, volume long")
    return J.job_ko(headlines, master, store, quotes, None, None)


@pytest.mark.parametrize("job", [_details, _light])
def test_few_codes_are_broadcast_and_more_give_the_same_rows(unhinted, monkeypatch, job):
    few = job(unhinted)
    assert "BroadcastHashJoin" in " ".join(x for x in _plan(few).splitlines() if "LeftSemi" in x)
    rows = sorted(map(str, few.collect()))
    monkeypatch.setattr(session, "BROADCAST_KEYS", 0)
    more = job(unhinted)
    assert not any("BroadcastHashJoin" in x for x in _plan(more).splitlines() if "LeftSemi" in x)
    assert sorted(map(str, more.collect())) == rows and rows


def test_six_digits_are_those_of_the_formatter(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 7, 999999, 1000000, 123456789012, -5, -1234567, None)], "k long")
    for r in keys.select(A.six_digits(F.col("k")).alias("a"), F.format_string("%06d", F.col("k")).alias("b")).collect():
        assert r.a == r.b


def test_equal_contents_are_cut_once(spark):
    from tickerlens.operators.sentiment import contains_any
    df = spark.createDataFrame([(i, "up and down") for i in range(50)] + [(50, "flat"), (51, None)], "id long, content string")
    words = spark.createDataFrame([("down",), ("and d",)], "word string")
    found = contains_any(df, "content", words)
    assert {r.id for r in found.where("has_word").collect()} == set(range(50)) and found.count() == 52
    # the contents themselves are a grouping key before they are dealt out
    assert "HashAggregate(keys=[_k1" in _plan(found) and "_c#" in "".join(x for x in _plan(found).splitlines() if "HashAggregate(keys=[_k1" in x)

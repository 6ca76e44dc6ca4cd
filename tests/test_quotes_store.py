import datetime as dt

from tickerlens.operators import quotes as Q
from tickerlens.operators import store as ST
from tickerlens.session import scratch_path


def test_last_valid_cases(spark):
    nan = float("nan")
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, nan), ("b", 1, nan), ("b", 2, nan),
            ("c", 1, None), ("c", 2, 3.0), ("c", 3, None)]
    df = spark.createDataFrame(rows, "k string, p int, v double")
    got = {r.k: r.last_value for r in Q.last_valid(df, ["k"], "p", "v").collect()}
    assert got == {"a": 2.0, "b": 0.0, "c": 3.0}


def test_latest_quote_and_attach_defaults(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    q = spark.createDataFrame([("A", d1, 10, 1, 1, 1, 1, 1, 1), ("A", d2, 20, 2, 2, 2, 2, 2, 1),
                               ("A", d2, 30, 3, 3, 3, 3, 3, 2)],
                              "code string, date timestamp, close long, diff long, open long, high long, "
                              "low long, volume long, tb long")
    latest = Q.latest_quote(q, tiebreak=["tb"])
    assert [r.close for r in latest.collect()] == [30]
    df = spark.createDataFrame([("A",), ("Z",)], "code string")
    got = {r.code: (r.close, r.volume) for r in Q.attach_quote(df, latest).collect()}
    assert got == {"A": (30, 3), "Z": (0, 0)}


def test_purge_keeps_null_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, "ok", "d1"), (2, "has Error", "d1"), (3, None, "d2"), (4, "에러", "d2"),
                                (5, "error lower", "d2")], "seq long, report_ string, date_ string")
    root = scratch_path(spark, "purge_test")
    ST.append(df, root, partition_by=["date_"])
    ST.purge(spark, root, df.schema, ["date_"])
    first = sorted(r.seq for r in ST.read_store(spark, root, schema=df.schema).collect())
    ST.purge(spark, root, df.schema, ["date_"])
    second = sorted(r.seq for r in ST.read_store(spark, root, schema=df.schema).collect())
    assert first == second == [1, 3, 5]


def test_reuse_reports(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "seq long, code string")
    store = spark.createDataFrame([("A", "r1"), ("A", "r2"), ("B", "x 에러가 발생 했습니다"), ("C", None)],
                                  "code_ string, report_ string")
    got = {r.seq: (r.report, r.needs_report) for r in ST.reuse_reports(df, store).collect()}
    assert got == {1: ("r2", False), 2: ("", True), 3: ("", True)}

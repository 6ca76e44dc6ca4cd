from pyspark.sql import functions as F

from tickerlens.operators import enrich as EN


def test_batch_enrich_fallback(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "한국"), (3, None)], "id int, t string")

    def fn(s):
        return s.encode("ascii").decode().upper()
    got = {r.id: r.out for r in EN.batch_enrich(df, fn, "t", "out", fallback_col="t").collect()}
    assert got == {1: "ABC", 2: "한국", 3: None}


def test_summary_request_drops_token(spark):
    df = spark.createDataFrame([("Acme", "동사는 제조", "성장")], "n string, o string, s string")
    r = df.select(EN.summary_request(F.col("n"), F.col("o"), F.col("s")).alias("p")).collect()[0].p
    assert "동사는" not in r and r.startswith("Please summarize") and "기업명 : Acme" in r


def test_ship_package(spark):
    from tickerlens.session import ship_package
    path = ship_package(spark)
    assert path.endswith(".zip")

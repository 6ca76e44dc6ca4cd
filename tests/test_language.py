from pyspark.sql import functions as F

from tickerlens.functions.language import detect_language, verdict

CASES = [  # reply, P13, P14 (hand cases)
    ("긍정문입니다", "P", "P"),
    ("이 문장은 부정문입니다", "N", "N"),
    ("부정문입니다", "P", "C"),
    ("긍정도 부정도 아님", "P", "C"),
    ("사실을 말함", "P", "C"),
    ("It is a negative sentence.", "N", "N"),
    ("negative", "P", "C"),
    ("Negative.", "P", "P"),
    ("It is a positive sentence", "P", "P"),
    ("a statement, negative", "P", "C"),
    ("한국 negative", "P", "P"),
    ("こんにちは", "P", "C"),
    ("", "P", "C"),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "r string")
    got = df.select(verdict("r", "P").alias("p"), verdict("r", "C").alias("c")).collect()
    assert [(g.p, g.c) for g in got] == [(c[1], c[2]) for c in CASES]


def test_detect_language(spark):
    df = spark.createDataFrame([("Hello, world!",), ("안녕하세요!",), ("こんにちは",), ("K",)], "t string")
    assert [r[0] for r in df.select(detect_language(F.col("t"))).collect()] == [
        "English", "Korean", "Unknown", "English"]

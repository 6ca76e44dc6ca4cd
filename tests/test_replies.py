"""The reply cache: one call per distinct input, none for what is known, failures retried."""
import os
import tempfile

from tickerlens.operators import replies as R
from tickerlens.session import scratch_path


def counting(folder, bad=()):
    def fn(text):
        with open(os.path.join(folder, "calls"), "a") as f:
            f.write(repr(text) + "\n")
        if text in bad:
            raise ValueError("not now")
        return text.upper()
    return fn


def calls(folder):
    path = os.path.join(folder, "calls")
    return sorted(open(path).read().split()) if os.path.exists(path) else []


def test_one_call_per_distinct_input_and_none_again(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else f"t{i}", "clash") for i in range(30)] + [(99, None, "x")], "id long, t string, key string").repartition(4)
    root, one, two = scratch_path(spark, "replies"), tempfile.mkdtemp(), tempfile.mkdtemp()
    out = R.enrich_cached(df, counting(one), "t", "out", root, fallback_value="-")
    assert out.columns == ["id", "t", "key", "out"]
    assert {(r.t, r.out) for r in out.collect()} == {("a", "A"), (None, "-"), *((f"t{i}", f"T{i}") for i in range(0, 30, 3))}
    assert out.count() == 31
    assert calls(one) == sorted(["'a'", *(f"'t{i}'" for i in range(0, 30, 3))])
    again = R.enrich_cached(df.union(spark.createDataFrame([(100, "new", "y")], df.schema)), counting(two), "t", "out", root)
    assert again.count() == 32 and calls(two) == ["'new'"]
    assert sorted(calls(one)) == calls(one) and len(calls(one)) == 11
    other = tempfile.mkdtemp()
    R.enrich_cached(df, counting(other), "t", "out", root, model="another").count()
    assert len(calls(other)) == 11  # another model's replies are its own


def test_failures_are_retried_up_to_a_bound(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, t string")
    root, folder = scratch_path(spark, "replies"), tempfile.mkdtemp()
    run = lambda bad: sorted(map(tuple, R.enrich_cached(df, counting(folder, bad), "t", "out", root, fallback_col="t", most_attempts=2).collect()))
    assert run(["b"]) == [(1, "a", "A"), (2, "b", "b"), (3, "b", "b")]
    assert [tuple(r) for r in R.failures(spark, root).collect()] == [("b", 1, "ValueError: not now")]
    assert run([]) == [(1, "a", "A"), (2, "b", "B"), (3, "b", "B")]
    assert calls(folder) == ["'a'", "'b'", "'b'"] and R.failures(spark, root).count() == 0
    root = scratch_path(spark, "replies")
    for _ in range(4):
        run(["b"])
    assert [tuple(r)[:2] for r in R.failures(spark, root).collect()] == [("b", 2)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, t string")
    assert R.enrich_cached(df, str.upper, "t", "out", scratch_path(spark, "replies")).count() == 0

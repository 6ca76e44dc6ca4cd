import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tickerlens.llm import mixing as M


def docs(seed, n=400):
    random.seed(seed)
    out = []
    for i in range(n):
        s = random.choice(["a"] * 6 + ["b", "C", "é", "日", None, ""])
        out.append((i, random.choice([None, "", "w \t\x0b"]) if random.random() < 0.1 else "w " * random.randint(1, 60) + " x", s))
    return out


def targets(rows, share=1.5):
    """Shares by weight, capped at twice a source's words, the excess shared again."""
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target = share * sum(size.values()), {}
    while True:
        free = [s for s in names if s not in target]
        full = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]
        if not full:
            target.update({s: left * weight[s] / sum(weight[x] for x in free) for s in free})
            return size, target
        for s in full:
            target[s] = 2.0 * size[s]
        left -= sum(target[s] for s in full)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = docs(seed)
    got = M.mix(frame(spark, rows)).collect()
    size, target = targets(rows)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 1
    again = M.mix(frame(spark, rows[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_schedule_is_even_and_complete(spark):
    counts = M.slot_counts(spark.createDataFrame([("a", 0, 10_000, 1.0, 600.0), ("b", 1, 10_000, 1.0, 300.0), ("c", 2, 100, 1.0, 100.0)],
                                                 "source string, s long, source_size long, weight double, target double"), 1)
    got = M.schedule(counts, 1000).collect()
    assert sorted(r.n for r in got) == list(range(1000))
    for s, n in ((0, 600), (1, 300), (2, 100)):
        mine = sorted((r.n, r["rank"]) for r in got if r.s == s)
        assert [x[1] for x in mine] == list(range(n))
        for k in range(0, 1000, 50):  # no source runs ahead by more than a low-discrepancy sequence's log2(1000)
            assert abs(sum(x[0] < k for x in mine) - n * k / 1000) <= 10


def test_cases(spark):
    empty = frame(spark, [(1, "a b", "s")]).limit(0)
    assert M.mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
    none = M.mix(frame(spark, [(1, None, "s"), (2, "", None), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 3
    same = M.mix(frame(spark, [(1, "a b", "s")] * 5)).collect()
    assert len(same) == 5 and sum(r.taken for r in same) == 15


def test_mixed_documents_repeat_rows(spark):
    rows = docs(3) + [(7, "same text here", "a")] * 3
    df = frame(spark, rows)
    got = M.mixed_documents(df)
    assert got.columns == df.columns
    size, target = targets(rows)
    n = {r[0]: r[1] for r in got.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(M.WORD)))).collect()}
    for s in size:
        assert abs(n.get(s, 0) - target[s]) <= 65  # within a document
    assert max(r[2] for r in got.where("doc_id <> 7").groupBy("doc_id", "text").count().collect()) <= 2


def test_main_path_is_native(spark):
    plan = M.mix(frame(spark, docs(1, 50)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

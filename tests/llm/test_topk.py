import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlens.llm import topk


def brute(vectors, every, k):
    out = []
    for q, a in vectors.items():
        if q % every == 0:
            s = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors.items() if i != q))[:k]
            out += [(q, n + 1, i, max(min(-v, 2**63 - 1), -2**63)) for n, (v, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, every, k, block):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")
    v = topk.integer_vectors(df, "vec_id", "embedding", 256)
    got = topk.exact_topk(v, F.pmod(F.col("vec_id"), F.lit(every)) == 0, k, block_rows=block)
    return sorted(tuple(r) for r in got.collect())


def floor(v):
    return [int(np.floor(256 * x)) for x in v]


def test_ties_repeats_nulls_and_ragged_vectors(spark):
    random.seed(3)
    rows = [(i, [random.choice([-0.5, 0.0, 0.25, 0.3]) for _ in range(4)], 0) for i in range(60)]
    rows += [(60, [1.0], 0), (61, [], 0), (62, [0.0] * 6, 0), (7, [9.0] * 4, 0)]  # 7 repeats: the smaller vector counts
    want = {i: floor(v) for i, v, _ in rows[:63]}
    want[7] = min(want[7], floor([9.0] * 4))
    bad = [(100, None, 0), (101, [None, 1.0], 0), (102, [float("nan")], 0), (103, [float("inf")], 0), (None, [1.0], 0)]
    assert run(spark, rows + bad, 3, 5, 16) == brute(want, 3, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**40 + i), float(-(2**41) + 3 * i)], 0) for i in range(12)]
    assert run(spark, rows, 2, 3, 5) == brute({i: floor(v) for i, v, _ in rows}, 2, 3)


def test_fewer_candidates_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0], 0), (1, [2.0], 0)], 50, 5, 8) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0], 0)], 50, 5, 8) == []
    assert run(spark, [], 50, 5, 8) == []


@pytest.mark.parametrize("seed", range(5))
def test_search_stops_early_and_is_exact(seed):
    r = np.random.default_rng(seed)
    rows = r.integers(-50, 50, (3000, 3)).astype(float)
    ids, order = r.permutation(3000), np.argsort(rows, axis=0, kind="stable")
    for j in range(5):
        got_ids, got = topk.threshold_search(ids, rows, order, int(ids[j]), rows[j], 5)
        want = sorted((-s, i) for s, i in zip(rows @ rows[j], ids) if i != ids[j])[:5]
        assert sorted(zip(-got, got_ids)) == want

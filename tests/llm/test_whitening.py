import math

import numpy as np
import pytest

from tickerlens.llm import whitening as W


def brute(rows, components=16):
    """Integers, exact deviations and a dense eigendecomposition of the covariance."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(x) for _, x in kept]
    d = max(set(lengths), key=lambda m: (lengths.count(m), m))
    kept = [(i, x) for i, x in kept if len(x) == d]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([(s - n * 1_000_000) / n for s in sums])
    xc = np.array(fit, dtype=np.float64) - 1_000_000 - mean
    e, u = np.linalg.eigh(xc.T @ xc / n)
    e, u = e[::-1], u[:, ::-1]
    k = int((e[:components] > 1e-13 * e.sum()).sum())
    dev = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in kept]
    y = (np.array([x for _, x in kept], dtype=np.float64) - 1_000_000 - mean) @ u[:, :k] / np.sqrt(e[:k])
    return kept, n, dev, e, k, y


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", i, 1) for i, v in rows], "vec_id long, embedding array<float>, x string, component long, i int").repartition(3)


def spectra(kind, n, d):
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
    scale = {"near": 1 + 0.01 * np.arange(d), "steep": 10.0 ** np.linspace(-1.5, 3, d), "gap": np.where(np.arange(d) < 5, 100.0, 0.5)}[kind]
    return (rng.standard_normal((n, d)) * scale) @ basis.T


@pytest.mark.parametrize("kind,n,d", [("near", 900, 48), ("steep", 500, 40), ("gap", 300, 50), ("near", 200, 7)])
def test_equals_dense_eigenvectors(spark, kind, n, d):
    rows = [(i, v) for i, v in enumerate(np.float32(spectra(kind, n, d)).tolist())]
    rows += [(5, rows[9][1]), (5, rows[5][1]), (None, rows[1][1]), (1000, None), (1001, [None] * d), (1002, [math.nan] + rows[0][1][1:]),
             (1003, [math.inf] + rows[0][1][1:]), (1004, rows[0][1][1:]), (1005, [])]
    kept, n_fit, dev, e, k, y = brute(rows)
    got = {}
    for r in W.whiten(frame(spark, rows)).collect():
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert k == min(16, d) and sum(len(v) for g in got.values() for v in g.values()) == k * len(kept)
    signs = [0] * k
    for (i, _), dv, row in zip(kept, dev, y):
        for c in range(k):
            for r in got[i, dv][c + 1]:
                assert r.n == n_fit and r.identity_error < 1e-9
                assert abs(r.explained / (e[c] / e.sum()) - 1) < 1e-9
                signs[c] = signs[c] or (1 if r.whitened * row[c] > 0 else -1)
                assert abs(r.whitened - signs[c] * row[c]) < 1e-7 * (1 + abs(row[c]))


def test_flat_spectrum(spark):
    """All variances equal: any orthonormal components will do."""
    rows = [(2 * i + s, [(1 - 2 * s) * 4.0 * (i == j) for j in range(40)]) for i in range(40) for s in (0, 1)]
    out = W.whiten(frame(spark, rows)).collect()
    y = np.zeros((80, 16))
    for r in out:
        y[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - 1 / 40) < 1e-9 and r.identity_error < 1e-9
    assert np.abs(y.T @ y / 80 - np.eye(16)).max() < 1e-9


def test_low_rank_few_rows_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(9)]
    out = W.whiten(frame(spark, line)).collect()
    assert {r.component for r in out} == {1} and len(out) == 9 and abs(out[0].explained - 1) < 1e-12
    wide = [(i, np.random.default_rng(i).standard_normal(60).tolist()) for i in range(5)]  # rank 4 of 60
    assert {r.component for r in W.whiten(frame(spark, wide)).collect()} == {1, 2, 3, 4}
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(frame(spark, [(1, None)])).count() == 0
    empty = W.whiten(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long():
    x = np.array([[2**40, 0], [0, 0], [3, 4]], dtype=np.int64)
    assert W.deviations(x, 3, np.array([0, 0], dtype=object)) == [None, 0, 9 * 25]
    assert W.deviations(x[2:], 3, [0, 0]) == [225]

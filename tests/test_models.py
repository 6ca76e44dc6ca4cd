"""Stored models: loaded for the same corpus, fitted anew for another."""
from tickerlens.operators import models as M
from tickerlens.operators import store as ST
from tickerlens.plans import jobs as J
from tickerlens.session import scratch_path


def test_a_model_is_fitted_once_for_a_corpus(spark, monkeypatch):
    rows = [(i, f"good w{i % 5} day" if i % 2 else f"bad w{i % 5}", i % 2) for i in range(40)]
    corpus = lambda r, n: spark.createDataFrame(r, "id long, document string, label int").repartition(n)
    root, fits = scratch_path(spark, "models"), []
    fit = J._fit
    monkeypatch.setattr(J, "_fit", lambda c: fits.append(1) or fit(c))
    plain = J.bow_model(corpus(rows, 3))
    fits.clear()
    one = J.bow_model(corpus(rows, 2), root)
    two = J.bow_model(corpus(rows[::-1], 5), root)  # the same rows in another order
    assert len(fits) == 1
    for m in (one, two):
        assert sorted(map(tuple, m.vocab.collect())) == sorted(map(tuple, plain.vocab.collect()))
        assert sorted(map(tuple, m.weights.collect())) == sorted(map(tuple, plain.weights.collect()))
    J.bow_model(corpus(rows + [(99, "other text", 1)], 2), root)
    assert len(fits) == 2 and len(ST.partition_values(ST.snapshot(spark, root), "fitted_on")) == 2
    rules = M.RULES
    monkeypatch.setattr(M, "RULES", rules + "x")  # other rules: another model
    J.bow_model(corpus(rows, 2), root)
    assert len(fits) == 3

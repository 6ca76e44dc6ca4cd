import random

import corpus_pipeline as P

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder, docs, items):
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def make():
    random.seed(4)
    vocab = {x: [f"{x}{random.choice('aeiou')}{random.choice('bdfgk')}{i}" for i in range(300)] for x in ("en", "de")}
    docs = []
    for i in range(120):
        lang = random.choice(["en", "de"])
        docs.append([i, " ".join(random.choices(vocab[lang], k=60)), lang, f"s{i % 4}"])
    docs[11][1] = docs[10][1]  # an exact copy
    w = docs[12][1].split()
    docs[13][1] = " ".join(w[:59] + ["changed"])  # a near copy
    items = [(1, " ".join(random.choices(vocab["en"], k=30)))]
    docs[14][1] = docs[14][1] + " " + items[0][1]  # holds a benchmark item
    docs[15][1] = "123 456 ### 789"  # no language
    return [(i, t, lang, s, len(t)) for i, t, lang, s in docs] + [(200, None, None, None, None), (201, "", "en", "s0", 0)], items


def test_each_stage_takes_effect_and_keeps_clean_documents(spark, tmp_path):
    docs, items = make()
    sf = tables(spark, tmp_path, docs, items)
    at, ids = spark.read.parquet(f"{sf}/documents.parquet"), {d[0] for d in docs}
    expected_gone = [{15, 200, 201}, {11, 13}, {14}]
    for (name, stage), gone in zip(P.STAGES, expected_gone):
        at = stage(spark, at, sf)
        assert at.dtypes == spark.read.parquet(f"{sf}/documents.parquet").dtypes, name
        ids -= gone
        assert sorted(r.doc_id for r in at.collect()) == sorted(ids), name
    mixed = P.mix(spark, at, sf)
    assert {r.doc_id for r in mixed.collect()} <= ids
    out = P.token_binary(spark, mixed, sf).collect()
    assert len(out) == mixed.count()
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_run_equals_the_stages_and_takes_an_empty_table(spark, tmp_path):
    docs, items = make()
    sf = tables(spark, tmp_path / "a", docs, items)
    at = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES:
        at = stage(spark, at, sf)
    assert sorted(map(tuple, P.run(spark, sf).collect())) == sorted(map(tuple, at.collect()))
    assert P.run(spark, tables(spark, tmp_path / "b", [], [])).count() == 0

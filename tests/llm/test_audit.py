import itertools
import random
import re

import pytest

from tickerlens.llm import audit as A


def brute(rows, labels):
    """Documents one by one, orders one by one."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = {}
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(f for f, hit in (
            ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)),
            ("D", bool(re.search(r"[#$%&*|]", t))), ("E", i is not None and i > first[t])) if hit)
        docs.setdefault(s or "", []).append((fails, i in good, i in toxic))
    out = {}
    for part, own in docs.items():
        by_letter = {f: 0 for f in "ABCDE"}
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                by_letter[f] += len(gone)
                before = len([d for d in own if f in d[0]]) - len(gone)
                left = [d for d in left if f not in d[0]]
                out[part, "".join(order), k + 1] = [len(left), len(gone), before, sum(d[0] == f for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, k), m in out.items():
            if p == part:
                m.append(by_letter[order[k - 1]])
    return sorted((*k, *m) for k, m in out.items())


def answer(df):
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(map(tuple, df.select(cols).collect()))


def corpus(seed):
    random.seed(seed)
    word = lambda: random.choice(["ab", "Cd", "é", "x#", "日本", "EF"]) + str(random.randint(0, 150))
    texts = [random.choice(["", " "]) + random.choice([" ", "\n", "\x0b", "  "]).join(word() for _ in range(random.choice([3, 150, 200, 201, 400]))) for _ in range(25)]
    texts += ["", None, "A" * 300, "same " * 300, "low " + " ".join(f"w{i}" for i in range(250))]
    rows = [(i, random.choice(texts), random.choice(["s", "s", "s", "t", "é", "", None])) for i in range(150)]
    rows += [(None, texts[0], "s"), (None, texts[0], "s"), (3, texts[1], "t"), (3, texts[1], "t"), (-1, texts[2], None), (200, texts[2], "only")]
    labels = [(random.randint(0, 160), random.choice([0, 1, None]), random.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1), (3, 1, 0), (3, 0, 1)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows, labels = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, part string, n int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert answer(A.audit(docs, marks)) == brute(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, marks).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert answer(A.audit(one, marks)) == brute([(1, None, None)], [])


def test_own_filters_and_many_parts(spark):
    """3,100 parts of 16 prefixes lie beyond the recursion's row limit of the session."""
    n = 3100
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('p', id) AS source", "if(id % 2 = 0, 'x', 'a longer text') AS text")
    marks = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    limit = spark.conf.get(A.ROW_LIMIT)
    spark.conf.set(A.ROW_LIMIT, "1000")
    try:
        out = A.audit(docs, marks, {"W": "n_words < 2", "L": "n_chars < 5"}, None)
        assert out.count() == n * 4
        assert spark.conf.get(A.ROW_LIMIT) == "1000"
    finally:
        spark.conf.set(A.ROW_LIMIT, limit)
    got = out.where("part = 'p0'").orderBy("filter_order", "step").select("filter_order", "removed", "redundant", "shapley", "good_lost").collect()
    assert [tuple(r) for r in got] == [("LW", 1, 0, 1, 1), ("LW", 0, 1, 1, 0), ("WL", 1, 0, 1, 1), ("WL", 0, 1, 1, 0)]
    with pytest.raises(ValueError):
        A.interactions(A.mask_cells(A.document_fails(docs), marks), "AA")

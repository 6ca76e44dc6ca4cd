import random
import re

import numpy as np
import pytest

from tickerlens.llm import neardup as N


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t, size):
    w = words(t)
    n = min(size, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows, size, percent):
    """(doc_id, n_shingles, component, kept) by comparing all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in sets:
        for j, b in sets:
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus(seed, n=120):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        kind = random.random()
        if rows and kind < 0.5:
            w = random.choice(rows).split()
            for _ in range(random.randint(0, 1 + len(w) // 12)):
                w[random.randrange(len(w))] = random.choice(vocab)
            rows.append(random.choice([" ", "\n", " \t "]).join(w).upper() if kind < 0.1 else " ".join(w))
        else:
            rows.append(" ".join(random.choices(vocab, k=random.choice([1, 2, 3, 5, 10, 40, 300]))))
    return list(enumerate(rows))


def run(spark, rows, size, percent=80):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n long").repartition(3)
    return sorted(map(tuple, N.duplicates(df, shingle=size, percent=percent).collect()), key=str)


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 5)])
def test_equals_brute_force(spark, seed, size):
    rows = corpus(seed)
    assert run(spark, rows, size) == sorted(brute(rows, size, 80), key=str)


def test_long_lists_by_pivots_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(N, "ALL_PAIRS", 2)
    monkeypatch.setattr(N, "PIVOTS", 1)
    random.seed(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):  # a chain: neighbours are near, the ends are not, all share much
        w = list(base)
        for j in range(i // 2):
            w[(7 * j) % 60] = f"c{j}"
        rows.append((i, " ".join(w)))
    assert run(spark, rows, 4) == sorted(brute(rows, 4, 80), key=str)


def test_cases(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "a b"), (3, "A  b"), (9, "b a"), (4, "one two three four five"), (2, "one two three four five")]
    assert run(spark, rows, 4) == sorted(brute(rows, 4, 80), key=str)
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "x y"), (2, "x y"), (1, "a b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in N.duplicates(df, shingle=4).collect()), key=str)
    assert got == sorted([(None, None, True), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False)], key=str)
    assert N.duplicates(df.limit(0), shingle=4).count() == 0


def test_ids_that_share_classes(spark):
    """An id links all the texts of its rows, whichever of them it represents."""
    base = " ".join(f"w{i}" for i in range(60))
    a, near, b, c = base, base + " end", "other words here", "third text of its own"
    rows = [(7, a), (7, b), (3, b), (9, a), (12, near), (20, c), (12, c), (20, None), (30, ""), (30, "lone"), (31, None), (31, None)]
    assert run(spark, rows, 4) == sorted(brute(rows, 4, 80), key=str)
    random.seed(5)
    mixed = [(random.randint(0, 70), t) for _, t in corpus(3, 100)]
    assert run(spark, mixed, 4) == sorted(brute(mixed, 4, 80), key=str)


def test_deduplicate_keeps_columns_and_one_of_each(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, "a b c", "y"), (None, "a b c", "z"), (3, None, None), (1, "a b c", "x")],
                               "doc_id long, text string, kept string")
    got = sorted(map(tuple, N.deduplicate(df, shingle=5).collect()), key=str)
    assert got == sorted([(1, "a b c", "x"), (None, "a b c", "z"), (3, None, None)], key=str)


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = (" ".join(f"w{i % 97}" for i in range(3000)) + " " + "q" * 5000 + " end").encode()
    whole = N.word_hashes(text)
    monkeypatch.setattr(N, "SEGMENT", 64)
    assert np.array_equal(whole, N.word_hashes(text))


def test_shared_is_below_the_expected_overlap():
    assert N.shared(64, 80) == 32 and N.shared(32, 80) == 12


def test_components_joined_by_more_edges(spark):
    random.seed(11)
    edges = [(random.randint(0, 90), random.randint(0, 90)) for _ in range(40)]
    more = [(random.randint(0, 120), random.randint(0, 120)) for _ in range(15)] + [(200, 201), (edges[0][0], 201)]
    plain = [e for e in edges if e[0] != e[1]], [e for e in more if e[0] != e[1]]
    e, m = (spark.createDataFrame(x, "a long, b long") for x in plain)
    expected = {tuple(r) for r in N.components(e.unionByName(m)).collect()}
    got = [tuple(r) for r in N.joined_components(N.components(e), m).collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert {tuple(r) for r in N.joined_components(N.components(e), m.limit(0)).collect()} == {tuple(r) for r in N.components(e).collect()}

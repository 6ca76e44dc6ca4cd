import hashlib
import random

import pytest

from tickerlens.llm import lines as L


def brute(rows, window=3):
    """(n_lines, n_removed, digest, text) of each row, in order of id, text and place."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5((rows[i][1] or "").encode()).digest(), i))
    seen, out = set(), {}
    for i in order:
        parts = (rows[i][1] or "").split("\n")
        gone = set()
        for p in range(len(parts) - window + 1):
            w = "\n".join(parts[p:p + window])
            if not w.encode().split():
                continue
            if w in seen:
                gone |= set(range(p, p + window))
            seen.add(w)
        left = "\n".join(x for p, x in enumerate(parts) if p not in gone)
        out[i] = (rows[i][0], len(parts), len(gone), hashlib.sha256(left.encode()).hexdigest(), left if gone else rows[i][1])
    return [out[i] for i in range(len(rows))]


def corpus(seed):
    random.seed(seed)
    stock = [random.choice(["", " ", "é", "line", "other"]) + str(random.randint(0, 9)) for _ in range(12)] + ["", " \t", ""]
    rows = [(i, "\n".join(random.choices(stock, k=random.randint(0, 14)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n\n\n"), (63, "x\n" * 30), (None, rows[5][1]), (7, "u\nv\nw"), (7, "u\nv\nw"), (7, "u\nv\nw"), (8, "u\nv\nw\nz")]
    return rows + [(64, "\n".join(f"own line {i}" for i in range(5000)))]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k string").repartition(3)
    want = brute(rows)
    got = sorted(map(tuple, L.line_digests(df).collect()), key=str)
    assert got == sorted([w[:4] for w in want], key=str)
    cut = L.deduplicate(df)
    assert cut.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == sorted([(w[0], w[4]) for w in want], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.line_digests(df).count() == 0 and L.deduplicate(df).count() == 0

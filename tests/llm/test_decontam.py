import hashlib
import random
import re

import pytest

from tickerlens.llm import decontam as D


def words(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for name, text in items:
            v = words(text)
            n = min(window, len(v))
            wins = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p:p + n]) in wins:
                    hit |= set(range(p, p + n))
                    found.add(str(name))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def data(seed):
    random.seed(seed)
    vocab = [random.choice(["a", "Bb", "cé", "d9", "EE", "日本", "f", "g"]) + random.choice(["", "x", "Y"]) for _ in range(14)]

    def prose(n):
        return "".join(random.choice(vocab) + random.choice([" ", ", ", ".\n", "-", " _ "]) for _ in range(n))
    items = [(i, prose(random.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(12)]
    items += [(100, items[4][1]), (101, ""), (102, "?!"), (10, items[3][1] + " tail of it")]
    docs = [(i, prose(random.randint(0, 60)) + (random.choice(items)[1].upper() if i % 2 else "") + " " + prose(random.randint(0, 300)))
            for i in range(30)]
    return docs + [(30, None), (31, ""), (32, "..."), (5, docs[5][1]), (33, items[6][1] * 3), (34, "pad " * 200 + items[5][1])], items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string").repartition(3)
    return d, spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("seed,block", [(1, 1 << 24), (2, 100)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)  # a benchmark in one block, or in many
    docs, items = data(seed)
    d, b = frames(spark, docs, items + [(None, docs[3][1]), (7, None)])
    got = D.contamination(d, b).drop("matches").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    kept = D.decontaminate(d, b)
    assert kept.columns == d.columns
    dirty = {(x[0], x[1], x[2]) for x in brute(docs, items) if x[5]}
    assert kept.count() == len(docs) - sum(x[5] for x in brute(docs, items)) and dirty


def test_longest_matches_and_locations(spark):
    item = " ".join(f"q{i}" for i in range(40))
    doc = "start of it " + " ".join(item.split()[5:30]) + " other " + " ".join(item.split()[:13])
    d, b = frames(spark, [(1, doc)], [(9, item)])
    got = D.contamination(d, b).first()
    assert sorted(tuple(m) for m in got.matches) == [(3, "9", 5, 25), (29, "9", 0, 13)]


def test_empty_tables(spark):
    d, b = frames(spark, [(1, "a b"), (2, None)], [(1, "z")])
    assert D.contamination(d.limit(0), b).count() == 0
    assert [tuple(r)[:4] for r in D.contamination(d, b.limit(0)).drop("matches").orderBy("doc_id").collect()] == [(1, 2, 0, 0), (2, 0, 0, 0)]
    assert D.decontaminate(d, b.limit(0)).count() == 2


def test_memory_of_a_shard_stays_near_its_text():
    import tracemalloc

    random.seed(3)
    vocab = [f"w{i}" for i in range(5000)]
    texts = [" ".join(random.choices(vocab, k=400)).encode() for _ in range(400)]
    judge = D.Judge([], 13)
    judge.single = D.TestBlock(["a"], [" ".join(vocab[:200]).encode()], 13)
    tracemalloc.start()
    try:
        n_words, n_hit, items, matches = judge.shard(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n_words.tolist() == [400] * 400 and not n_hit.any()
    assert peak < 8 * sum(map(len, texts))  # 16 times it when all words of the shard were held


def test_a_task_leaves_no_memory_in_the_pool(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    from tickerlens.llm import tables

    seen = []
    monkeypatch.setattr(tables, "pa", SimpleNamespace(default_memory_pool=lambda: SimpleNamespace(release_unused=lambda: seen.append("released")), RecordBatch=pa.RecordBatch))

    def run(batches):
        for b in batches:
            seen.append(b)
            yield b + 1
        seen.append("done")
    assert list(tables.lean(run)([1, 2])) == [2, 3]
    assert seen == [1, 2, "done", "released"]

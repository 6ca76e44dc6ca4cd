import collections
import hashlib
import random

import numpy as np
import pytest

from tickerlens.llm import substrings as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def texts(seed):
    random.seed(seed)
    def prose(n):
        return "".join(random.choice("abcdeé \n") for _ in range(n))
    passage, line = prose(500), prose(260)
    out = [prose(random.randint(0, 900)) for _ in range(20)]
    out += [prose(random.randint(0, 200)) + passage[a:a + random.randint(150, 400)] + prose(random.randint(0, 90)) for a in range(0, 240, 8)]
    out += [line + prose(5) + line, "ab" * 400, "x" * 1000, "x" * 199, "x" * 200, None, "", out[3], out[3], prose(199) + "\0" + passage]
    return out


@pytest.mark.parametrize("seed,hot", [(1, 512), (2, 2)])
def test_equals_brute_force(spark, seed, hot):
    rows = [(i if i % 7 else None if i == 7 else i, t, "x") for i, t in enumerate(texts(seed))]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string").repartition(4)
    got = S.repeated(df, hot=hot).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(brute([t for _, t, _ in rows], 200))
    for r in got:
        assert r.n_removed == sum(b - a for a, b in zip(r.removed_from, r.removed_to)) and r.n_spans == len(r.removed_from)


def test_empty_table(spark):
    assert S.repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_backward_extension_finds_all_repeats(seed):
    r = random.Random(seed)
    length = r.choice([9, 10, 25, 40])
    base = bytes(r.choice(b"ab") for _ in range(70))
    parts = {bytes(r.choice(b"abc\0") for _ in range(r.randint(0, 20))) + base[(a := r.randint(0, 50)):a + r.randint(5, 60)] for _ in range(5)}
    contents = sorted(parts)
    weights = np.array([r.choice([1, 1, 2]) for _ in contents], float)
    seen = collections.Counter()
    for c, w in zip(contents, weights):
        for i in range(len(c) - length + 1):
            seen[c[i:i + length]] += w
    want = [[i for i in range(len(c) - length + 1) if seen[c[i:i + length]] > 1] for c in contents]
    assert [x.tolist() for x in S.repeated_windows(contents, weights, length)] == want


def test_anchors_follow_content_across_pieces(monkeypatch):
    r = np.random.default_rng(1)
    data = r.integers(97, 105, 5000, dtype=np.uint8)
    whole = S.anchors(data)
    monkeypatch.setattr(S, "PIECE", 333)
    for a, b in zip(whole, S.anchors(data)):
        assert np.array_equal(a, b)
    shifted = S.anchors(np.concatenate([data[100:700], data[2000:2600]]))
    assert np.array_equal(shifted[0][:401], whole[0][100:501] - 100)  # the same windows, the same places


def test_anchor_that_recurs_inside_few_texts_is_hot_by_its_bytes(spark):
    r = random.Random(5)
    prefix = "2024-01-01 00:00:00 host app INFO request served by worker "  # in every line, with other surroundings
    lines = ["\n".join(prefix + "".join(r.choices("abcdefgh", k=220)) for _ in range(60)) for _ in range(3)]
    lines.append(lines[0][:700] + "tail")
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    counts = collections.Counter()
    cut = [(h, k, [x], t[x:x + 368]) for k, t in ((str(i).encode(), t.encode()) for i, t in enumerate(lines))
           for h, x in ((1, x) for x in range(0, len(t) - 368, 280))]
    cut.append((2, b"z", list(range(1000)), b"y" * 200))  # one segment at many places
    cut += [(3, b"z", [0], b"w" * 200)]
    for h, _, starts, content in cut:
        counts[h] += len(content) + 8 * len(starts)
    frame = spark.createDataFrame(cut, "h long, k binary, starts array<long>, content binary").repartition(3)
    assert {x.h for x in S.hot_anchors(frame, 4096).collect()} == {h for h, n in counts.items() if n > 4096} == {1, 2}
    # one text above the bound by its own lines takes the counted path, to the same result
    got = S.repeated(docs, hot=4096).orderBy("doc_id").collect()
    assert [(x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got] == brute(lines, 200)
    assert S.HOT <= S.SHARD_BYTES

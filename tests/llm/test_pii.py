import hashlib
import random
import re

import pytest

from tickerlens.llm import pii

# the contract's own patterns, as the plain check
PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1]))
        return 13 <= len(d) <= 19 and total % 10 == 0
    return True


def plain(text):
    return [(k, *m.span()) for k, p in PLAIN for m in re.finditer(p, text) if valid(k, m[0])]


def named(spans):
    return [(pii.KINDS[k], a, b) for k, a, b in spans]


@pytest.mark.parametrize("seed", range(30))
def test_base_equals_the_plain_patterns(seed):
    r = random.Random(seed)
    bits = ["a@b.c", "@", "x.y@z-1.org.uk", "..@a.b.", "a@b@c.d", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", ".", "4111 1111 1111 1111",
            "4111-1111-1111-1111", "4012888888881881", "5", " ", "-", "+1 (212) 555-0100", "+", "+49 30 123456", "(", ")", "é", "日", "w", "\n", "99999999999999999999", "%+", "0"]
    for _ in range(200):
        t = "".join(r.choices(bits, k=r.randint(0, 12)))
        assert named(pii.base_spans(t)) == plain(t), t


def test_long_runs_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "@" * 100_000, "a@" * 100_000, "+1 " + "- " * 100_000, "(555) " * 50_000, " at " * 50_000):
        spans = pii.base_spans(t)
        pii.candidates(t, spans)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string").repartition(3)


def test_context_finds_what_the_base_patterns_miss(spark):
    random.seed(2)
    rows = [(i, f"Please write to user{i}@mail{i}.org today, or phone me on +1 (212) 555-{1000 + i} soon") for i in range(8)]
    hidden = "Please write to jane at corp dot org today, or phone me on (212) 555-7777 soon"
    clean = "the score was 212-555-0000 points at home dot com prices rose"
    got = {r.doc_id: r for r in pii.find(frame(spark, rows + [(50, hidden), (51, clean), (52, hidden)])).collect()}
    for i in (50, 52):
        assert got[i].n_email == got[i].n_phone == 0 and got[i].n_added == 2
        found = [hidden[int(s.split(":")[1]):int(s.split(":")[2])] for s in got[i].spans.split(",")]
        assert found == ["jane at corp dot org", "(212) 555-7777"]
    assert got[51].spans == ""
    for i, t in rows:
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in plain(t))


def test_cases(spark):
    rows = [(1, None), (2, ""), (None, "é a@b.co"), (3, "a@b.co 4111 1111 1111 1111"), (3, "a@b.co 4111 1111 1111 1111")]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_card, r.base_sha256, r.spans) for r in pii.find(frame(spark, rows)).collect())
    want = []
    for i, t in rows:
        p = plain(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in p)
        want.append((-1 if i is None else i, sum(x[0] == "email" for x in p), sum(x[0] == "card" for x in p), hashlib.sha256(text.encode()).hexdigest(), text))
    assert got == sorted(want)
    assert pii.find(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("address", ["bob(@)corp.org", "bob (@) corp.org", "bob[at ]corp.org", "bob ( at ) corp.org", "bob[@]corp.org", "bob at corp.org"])
def test_loose_address_does_not_depend_on_other_words(address):
    for before in ("write to ", "look at this, write to "):
        text = before + address + ", please"
        assert [text[a:b] for k, a, b in pii.candidates(text, pii.base_spans(text)) if k == 0] == [address]


def added(row, text):
    return [text[int(a):int(b)] for _, a, b in (s.split(":") for s in row.spans.split(",") if s)]


def test_accepted_candidates_are_seeds_and_contexts_enclose_other_shapes(spark):
    rows = [(i, f"phone me on +1 (212) 555-{1000 + i} soon") for i in range(16)]
    rows += [(100 + i, f"phone me on (212) 555-{7000 + i} soon") for i in range(3)]
    rows += [(200 + i, f"ring desk (212) 555-{7000 + i} daily") for i in range(3)]  # the second hop's context
    rows += [(300, "ring desk (212) 555-8001 daily"), (301, "phone me on 030 1234567 soon"), (302, "phone me on 06 12 34 56 78 soon"),
             (303, "phone me on 912 345 678 soon"), (304, "lot 030 7654321 sold")]
    got = {r.doc_id: added(r, dict(rows)[r.doc_id]) for r in pii.find(frame(spark, rows)).collect()}
    assert got[100] == ["(212) 555-7000"] and got[200] == ["(212) 555-7000"]  # the first hop
    assert got[300] == ["(212) 555-8001"]
    assert (got[301], got[302], got[303], got[304]) == (["030 1234567"], ["06 12 34 56 78"], ["912 345 678"], [])


def test_broad_spans():
    text = "müller@firma.de. fe80::1ff:2 at 12:30:45, call (030) 123/4567! 4111.1111.1111.1111 and 12345"
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in pii.broad(text)] == [
        ("email", "müller@firma.de"), ("ip", "fe80::1ff:2"), ("phone", "(030) 123/4567"), ("card", "4111.1111.1111.1111")]


def brute_accepted(rows):
    """Patterns and instances by plain loops: scores by rounds, accepted ones as seeds, until none is added."""
    edges, accepted = {}, set()
    for kind, value, seed, patterns in rows:
        for p in patterns:
            edges[kind, p, value] = edges.get((kind, p, value), False) or seed
    while True:
        by = {}
        for (k, p, v), seed in edges.items():
            by.setdefault((k, p), {})[v] = seed
        fixed = {kp: vs for kp, vs in by.items() if pii.MIN_SEEDS <= sum(vs.values()) < len(vs)}
        scores = {}
        while True:
            trust = {kp: (sum(vs.values()) + sum(scores.get((kp[0], v), 0) for v, s in vs.items() if not s)) / (len(vs) + pii.SMOOTH) for kp, vs in fixed.items()}
            new = {}
            for (k, p), vs in fixed.items():
                for v, s in vs.items():
                    if not s:
                        new[k, v] = 1 - (1 - new.get((k, v), 0)) * (1 - min(trust[k, p], 0.999))
            if not any(x > scores.get(kv, 0 if not scores else -1) + pii.STABLE for kv, x in new.items()):
                scores = new
                break
            scores = new
        got = {kv for kv, x in scores.items() if x >= pii.ACCEPT}
        if not got:
            return accepted
        accepted |= got
        edges = {(k, p, v): s or (k, v) in got for (k, p, v), s in edges.items()}


@pytest.mark.parametrize("seed", range(4))
def test_graph_equals_brute_force(spark, seed):
    random.seed(seed)
    rows = []
    for _ in range(60):
        k, v = random.randint(0, 1), random.randint(0, 30)
        rows.append((k, f"v{v}", v < 9, [f"p{random.randint(0, 2 + v % 7)}" for _ in range(random.randint(1, 3))]))
    df = spark.createDataFrame(rows, "kind int, value string, seed boolean, patterns array<string>")
    assert {tuple(r) for r in pii.bootstrap(df).collect()} == brute_accepted(rows)


def test_no_length_is_too_long():
    local, word = "a.b" * 80, "w" * 5000
    text = f"mail {local}@host.example.org or {local} at host dot org"
    assert [text[a:b] for _, a, b in pii.candidates(text, [])] == [f"{local}@host.example.org", f"{local} at host dot org"]
    odd = f"x {local}é@host"
    assert [odd[a:b] for _, a, b in pii.candidates(odd, [])] == [f"{local}é@host"]
    assert pii.contexts(f"{word} tel 5550001 {word}", len(word) + 5, len(word) + 12) == ["tel _", f"_ {word}", f"{word} tel _"]

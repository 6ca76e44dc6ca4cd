import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickerlens.llm import license_rules as R
from tickerlens.llm import licenses as L

RULES = R.rules()
COMPILED = [(r, re.compile(r.regex[1:])) for r in RULES]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def brute(text):
    """Every rule at every word, every pair of hits."""
    w = words_of(text)
    places = [(i, label) for phrase, _, label in L.BASE for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    hits = []
    for i in range(len(w)):
        window = " ".join(w[i:i + R.WINDOW]) + " "
        for r, regex in COMPILED:
            if m := regex.match(window):
                hits.append((i, i + m[0].count(" "), r))
    order = lambda h: (h[2].priority, h[0] - h[1], h[2].number)
    kept = [h for h in hits if not any(o[0] <= h[0] and o[1] >= h[1] and order(o) < order(h) for o in hits)]
    at = [p for p, _ in places]
    marks = sorted({m for _, m in places})
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(marks), ",".join(sorted({*marks, *(h[2].label for h in kept)})),
            max([h[2].score for h in kept] + [L.BASE_SCORE] * bool(at) + [0.0]))


TEXTS = [
    None, "", " \n", "under the MIT license", "Under-the\tMIT, License under the mit license", "Under the MİT license", "under the Kit license",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "Apache License, Version 20", "CC BY-NC 4.0 and CC-BY-NC-SA 4.0", "cc by nc cc by nc cc by nc",
    "SPDX-License-Identifier: GPL-2.0-or-later", "https://creativecommons.org/licenses/by-nc-nd/4.0/", "This is distributed under the terms of the GNU General Public Licence, version 3",
    "released into the public domain", "License: BSD 3-Clause. All rights reserved.", "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mit dem Hund mit license plate", "mit", "the mit license", "apache license version 2 apache license version 2", "x " * 50 + "cc by nc", "é" + "cc by nc",
]


def corpus(seed):
    random.seed(seed)
    bits = [t for t in TEXTS if t] + ["licensed under", "the", "mit license", "version 2", "gpl", "apache", "license", "cc by", "nc", "sa 4.0", "open", "data", "GNU", "word"]
    return TEXTS + [random.choice([" ", "\n", ", "]).join(random.choices(bits, k=random.randint(1, 12))) for _ in range(60)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts = corpus(seed)
    rows = [(i // 2, t, "clash", i) for i, t in enumerate(texts)] + [(None, "cc by nc", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, hits long").repartition(3)
    got = sorted(map(tuple, L.license_labels(df).collect()), key=repr)
    assert got == sorted([(r[0], *brute(r[1])) for r in rows], key=repr)


def test_very_long_text(spark):
    text = "filler word " * 60_000 + "under the MIT License. CC BY-NC 4.0 " * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = L.license_labels(df).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (147_000, 6000, 120_000, 146_995)
    assert r.labels == "cc-by-nc,mit"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.license_labels(df).count() == 0


def test_spans_and_own_rules(spark):
    df = spark.createDataFrame([(1, "see the acme public terms, acme public terms v2")], "doc_id long, text string")
    own = [R.Rule(0, "acme", "name", ("acme",), "terms", "^acme public terms "), R.Rule(1, "acme-2", "name", ("acme",), "terms", "^acme public terms v2 ")]
    r = L.scan(df, signatures=own, base=[("public terms", "public", "acme")]).first()
    assert [(h.start, h.stop, h.label) for h in r.hits] == [(2, 5, "acme"), (5, 9, "acme-2")]
    assert [(p.at, p.label) for p in r.places] == [(3, "acme"), (6, "acme")]


def test_rules_are_hundreds_of_different_regexes():
    assert len(RULES) > 500 and len({(r.label, r.regex) for r in RULES}) > 500
    for r in RULES:
        assert "'" not in r.regex and "\\" not in r.regex and r.keys


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_gates_let_every_match_through(data):
    """Each string that a rule matches begins with a keyword of it, holds its plain word and fits the window."""
    r = data.draw(st.sampled_from(RULES))
    m = data.draw(st.from_regex(re.compile(r.regex + r"\Z", re.ASCII), fullmatch=True).filter(lambda x: x == " ".join(words_of(x)) + " "))
    assert m.split(" ")[0] in r.keys and r.needle in m and m.count(" ") <= R.WINDOW

"""Operator 13: license scans by ordered signature rules. DataFrame functions only.

A text becomes lower-case words. Hundreds of regexes (``license_rules``) are looked up by
keyword: a rule is tried only where one of its keywords stands, and only if its plain word is
among the next words. Each hit is an interval of words. A hit is suppressed if it lies within
another that comes before it in order (priority of the form, then length, then rule), so that
"cc by nc" inside "cc by nc sa 4.0" gives way. Order and containment carry over from hit to hit,
so what survives doesn't depend on the order of the tests. All of it happens in the document's
row: a hit looks back over the few hits that can contain it, nothing is shuffled, and the work
is linear in the text and in its hits, however many it has.

Base phrases are places where their words stand one after another; their labels always stay.

Cases: null text counts as empty: no words, no labels, score 0; repeated ids and rows are rows
of their own; no text is cut; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.license_rules import WINDOW, Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase, its rarest word, label.
BASE = [("under the mit license", "mit", "mit"), ("apache license version 2", "apache", "apache-2"), ("cc by nc", "cc", "cc-by-nc")]
BASE_SCORE = 0.9


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_map(signatures: list[Rule]) -> Column:
    """A constant map: keyword -> its rules in order."""
    by_key: dict[str, list[Rule]] = {}
    for r in signatures:
        for k in r.keys:
            by_key.setdefault(k, []).append(r)
    one = lambda r: (f"named_struct('rule', {r.number}, 'label', {_quoted(r.label)}, 'needle', {_quoted(r.needle)}, "  # noqa: E731
                     f"'regex', {_quoted(r.regex)}, 'priority', {r.priority}, 'score', {r.score}D)")
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, array({', '.join(map(one, rs))})" for k, rs in by_key.items()) + ")")


def base_places(words: Column, base: list[tuple[str, str, str]]) -> Column:
    """array<struct<at, label>> of the places of all base phrases."""
    def places(phrase: str, rare: str, label: str) -> Column:
        own = phrase.split(" ")
        k = own.index(rare)
        at = F.filter(F.transform(words, lambda w, i: F.when(w == rare, i - k)), lambda i: i.isNotNull())

        def stands(i: Column) -> Column:
            ok = i >= 0
            for j, w in enumerate(own):
                if j != k:
                    ok = ok & F.coalesce(F.get(words, i + j) == w, F.lit(False))
            return ok
        return F.transform(F.filter(at, stands), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
    return F.concat(*[F.when(F.array_contains(words, rare), places(phrase, rare, label))
                      .otherwise(F.expr("cast(array() as array<struct<at: int, label: string>>)")) for phrase, rare, label in base])


def hits(words: Column, keywords: Column, by_key: Column) -> Column:
    """array (by place) of arrays of struct<start, stop, rule, label, priority, score>: all rules that match."""
    def at_place(i: Column) -> Column:
        last = F.least(i + (WINDOW - 1), F.size(words) - 1)
        window = F.concat(F.array_join(F.transform(F.sequence(i, last), lambda k: F.get(words, k)), " "), F.lit(" "))

        def tried(w: Column) -> Column:
            found = F.transform(F.filter(F.try_element_at(by_key, F.get(words, i)), lambda r: F.contains(w, r["needle"])), lambda r: F.struct(
                i.alias("start"), (i + F.regexp_count(F.regexp_substr(w, r["regex"]), F.lit(" "))).alias("stop"),
                *[r[c].alias(c) for c in ("rule", "label", "priority", "score")]))
            return F.filter(found, lambda h: h["stop"] > h["start"])
        return _let(window, tried)

    places = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(keywords, w), i)), lambda i: i.isNotNull())
    return F.filter(F.transform(places, at_place), lambda hs: F.size(hs) > 0)


def _before(a: Column, b: Column) -> Column:
    """Whether hit ``a`` comes before ``b`` in order."""
    by_length = (a["stop"] - a["start"]) - (b["stop"] - b["start"])
    return ((a["priority"] < b["priority"]) | (a["priority"] == b["priority"])
            & ((by_length > 0) | (by_length == 0) & (a["rule"] < b["rule"])))


def surviving(found: Column) -> Column:
    """The hits, as one array, that no earlier one contains. Places differ, so what can contain
    a hit stands at one of the last ``WINDOW`` places."""
    def kept(here: Column, j: Column) -> Column:
        def contained(h: Column) -> Column:
            return F.exists(F.sequence(F.greatest(F.lit(0), j - (WINDOW - 1)), j), lambda k: F.exists(
                F.get(found, k), lambda o: (o["start"] <= h["start"]) & (o["stop"] >= h["stop"]) & _before(o, h)))
        return F.filter(here, lambda h: ~contained(h))
    return F.flatten(F.transform(found, kept))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", signatures: list[Rule] | None = None,
         base: list[tuple[str, str, str]] = BASE) -> DataFrame:
    """(doc_id, n_words, places array<struct<at, label>>, hits array<struct<start, stop, rule,
    label, priority, score>>): base places, and the rules' hits that survive, of each row."""
    signatures = rules() if signatures is None else signatures
    by_key = rule_map(signatures)
    keys = sorted({k for r in signatures for k in r.keys} | {rare for _, rare, _ in base})
    keywords = F.array(*[F.lit(k) for k in keys])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # lower() also changes letters beyond A-Z, which can only let more texts through this gate
    gate = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("rough"))
    gate = gate.select("doc_id", "text", F.size("rough").cast("long").alias("n_words"), F.arrays_overlap("rough", keywords).alias("open"))
    nothing = F.array().cast("array<string>")
    words = gate.select("doc_id", "n_words", F.when(F.col("open"), F.regexp_extract_all(
        F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))).otherwise(nothing).alias("words"))
    out = words.select("doc_id", "n_words", _let(F.col("words"), lambda w: F.struct(
        base_places(w, base).alias("places"), _let(hits(w, keywords, by_key), surviving).alias("hits"))).alias("found"))
    return out.select("doc_id", "n_words", "found.places", "found.hits")


def license_labels(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row."""
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    starts, marks = F.col("places")["at"], F.col("places")["label"]
    best = F.greatest(F.coalesce(F.array_max(F.col("hits")["score"]), F.lit(0.0)), F.when(F.size("places") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)))
    return scan(docs, **columns).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), joined(marks).alias("base_labels"),
        joined(F.concat(marks, F.col("hits")["label"])).alias("labels"), best.alias("score"))

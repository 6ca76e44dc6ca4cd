import random

import numpy as np
import pytest

from tickerlens.llm import langid as L

SOUND = {"en": ["th", "er", "on", "an", "ing", "ha", "st"], "de": ["sch", "ein", "ch", "ung", "ö", "ß", "ver"], "fr": ["eau", "é", "oi", "que", "è", "ment", "ç"]}


def prose(lang, n):
    return " ".join("".join(random.choices(SOUND[lang], k=random.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    random.seed(1)
    out = []
    for i in range(600):
        lang = random.choice(list(SOUND))
        out.append((i, prose(lang, random.randint(1, 80)), lang, f"host-{lang}" if i % 3 else "mixed"))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, probability double").repartition(3)


def test_held_out_accuracy_without_and_with_other_evidence(spark, rows):
    model = L.fit(frame(spark, rows[:300]), "doc_id", "text", "lang")
    held = [(i, t, None, s) for i, t, _, s in rows[300:]]
    truth = {i: lang for i, _, lang, _ in rows[300:]}
    got = L.identify_documents(frame(spark, held), model).collect()
    alone = np.mean([r.text_language == truth[r.doc_id] for r in got])
    fused = np.mean([r.language == truth[r.doc_id] for r in got])
    assert alone > 0.9 and fused > 0.95 and not any(r.rejected for r in got)


def test_other_evidence_decides_short_texts(spark, rows):
    extra = [(1000, "on", "en", "host-en"), (1001, "on", "de", "host-de")]
    got = {r.doc_id: r.language for r in L.identify_documents(frame(spark, rows + extra)).collect()}
    assert got[1000] == "en" and got[1001] == "de"


def test_rejects_what_is_no_language_and_keeps_the_rest(spark, rows):
    odd = [(2000, None, "en", "h"), (2001, "", None, None), (2002, "12345 ### 67 !!", "en", "h"), (2003, "日本語" * 30, "en", "h"),
           (2004, prose("de", 40000), None, None), (None, prose("fr", 30), "fr", "h"), (5, rows[5][1], rows[5][2], rows[5][3])]
    df = frame(spark, rows + odd)
    got = [r.doc_id for r in L.keep_identified(df).select("doc_id").collect()]
    assert {2000, 2001, 2002}.isdisjoint(got) and 2004 in got and None in got
    assert set(got) >= {r[0] for r in rows} and got.count(5) == 2
    assert L.keep_identified(df).columns == df.columns


def test_no_labels_reject_nothing_and_empty_tables(spark, rows):
    bare = frame(spark, [(1, "abc", None, None), (2, None, None, "s")])
    assert L.keep_identified(bare).count() == 2
    assert L.identify_documents(bare.limit(0)).count() == 0


def test_pages_use_markup_address_and_host(spark, rows):
    model = L.fit(frame(spark, rows), "doc_id", "text", "lang")
    html = '<!DOCTYPE html><html class="x" lang="{}-XX"><script>var a="th th th";</script><p>{}</p></html>'
    pages = [(i, f"https://www.{s}.example.{'org' if lang == 'fr' else 'com'}/x?y=1", html.format(lang, t)) for i, t, lang, s in rows[:200]]
    pages += [(900, None, None), (901, "no address", "<p>" + prose("fr", 30)), (902, "http://u@h.org:8/x", "")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in L.identify_pages(df, model).collect()}
    assert len(got) == 203 and got[901].language == "fr" and got[900].rejected and got[902].rejected
    assert np.mean([got[i].language == lang for i, _, lang, _ in rows[:200]]) > 0.97


def test_long_text_is_counted_whole(monkeypatch):
    text = ("abc def " * 1000).encode()
    whole = np.concatenate(list(L.trigram_buckets(text)))
    monkeypatch.setattr(L, "PIECE", 100)
    assert np.array_equal(whole, np.concatenate(list(L.trigram_buckets(text))))


def test_every_label_has_a_model_however_rare(spark, rows):
    rare = [(3000 + i, t, lang, "h") for i, (t, lang) in enumerate([("日本語の文章です。", "ja"), ("Это русский текст.", "ru"), ("Ýol bilen gitdik.", "tk")])]
    labels = [(4000 + i, prose("en", 10), f"x{i}", "h") for i in range(70)]
    df = frame(spark, rows + rare + labels)
    model = L.fit(df, "doc_id", "text", "lang")
    assert set(model.languages) == {*SOUND, "ja", "ru", "tk", *(f"x{i}" for i in range(70)), L.UND}
    got = {r.doc_id: r for r in L.identify_documents(frame(spark, rows + rare)).collect()}
    assert [(got[i].text_language, got[i].rejected) for i, *_ in rare] == [("ja", False), ("ru", False), ("tk", False)]


def test_sample_is_bounded_in_each_label(spark, rows):
    few = L.fit(frame(spark, rows), "doc_id", "text", "lang", sample_rows=8)
    assert few.languages == [*sorted(SOUND), L.UND]
    assert (few.logs > np.log(L.EVEN / L.BUCKETS) + 1e-3).sum() < (L.fit(frame(spark, rows), "doc_id", "text", "lang").logs > np.log(L.EVEN / L.BUCKETS) + 1e-3).sum()


def test_und_does_not_depend_on_the_size_of_the_sample():
    counts = np.zeros(L.BUCKETS)
    counts[:1000] = 3
    assert np.allclose(L.log_shares(counts), L.log_shares(counts * 10_000))
    assert L.log_shares(counts)[-1] < -np.log(L.BUCKETS) - L.UND_PENALTY  # an unseen trigram counts for und


def test_unfitted_declared_language_is_rejected_only_without_letters(spark, rows):
    model = L.fit(frame(spark, rows), "doc_id", "text", "lang")
    held = [(1, "日本語の文章です。" * 9, "ja", "h"), (2, "日本語の文章です。" * 9, "en", "h"), (3, "12 34", "ja", "h")]
    assert {r.doc_id: r.rejected for r in L.identify_documents(frame(spark, rows + held), model).collect() if r.doc_id in (1, 3)} == {1: False, 3: True}

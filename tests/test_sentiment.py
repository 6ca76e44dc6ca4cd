import pytest
from pyspark.sql import functions as F

from tickerlens.operators import features as FE
from tickerlens.operators import sentiment as SE


@pytest.fixture()
def labelled(spark):
    return spark.createDataFrame([(1, "P", "주가 하락 우려"), (2, "P", "상승"), (3, "N", "급락 하락"),
                                  (4, "N", "보합"), (5, "P", None)], "id int, pn string, content string")


def test_keyword_override_branches(spark, labelled):
    words = spark.createDataFrame([("하락", "ko")], "nag_word string, lang string")
    got = {r.id: r.pn_final for r in SE.keyword_override(labelled, "pn", "content", words, "nag_word").collect()}
    assert got == {1: "N", 2: "P", 3: "N", 4: "C", 5: "P"}
    empty = spark.createDataFrame([], "nag_word string, lang string")
    got = {r.id: r.pn_final for r in SE.keyword_override(labelled, "pn", "content", empty, "nag_word").collect()}
    assert got == {1: "P", 2: "P", 3: "N", 4: "N", 5: "P"}


@pytest.mark.parametrize("n", [0, 10, 100, 10_000])
@pytest.mark.parametrize("empty_word", [False, True])
def test_contains_any_is_the_same_at_every_dictionary_size(spark, n, empty_word):
    texts = ["주가 하락 우려", "상승", "xw42y", "w9", "", None, "a" * 5000 + "zebra crossing", "z" * 4095 + "ebra", "ab\ncd"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    own = ["하락", "ebra", "b\nc", "w42", "zz"] + ([""] if empty_word else [])
    fill = [f"#{i}" for i in range(n)]
    words = spark.createDataFrame([(w,) for w in own + fill] + [(None,)], "word string")
    got = {r.id: r.has_word for r in SE.contains_any(df, "content", words).collect()}
    assert got == {i: t is not None and any(w in t for w in own + fill) for i, t in enumerate(texts)}


def test_lexicon_compound_published_values(spark):
    lex = spark.createDataFrame([("good", 19), ("bad", -31)], "word string, tenths long")
    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "nothing here"), (4, "")], "id int, t string")
    df = df.withColumn("tokens", FE.tokenise("t"))
    got = {r.id: r for r in SE.lexicon_sentiment(df, ["id"], "tokens", lex).collect()}
    assert got[1].compound == 0.4404 and got[1].pos == 1.0
    assert got[2].compound == -0.6249 and got[2].neg == 1.0
    assert (got[3].compound, got[3].neu) == (0.0, 1.0)
    assert (got[4].compound, got[4].neg, got[4].neu, got[4].pos) == (0.0, 0.0, 0.0, 0.0)


def test_bow_score_no_vocabulary_token_is_n_50(spark):
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    tf = spark.createDataFrame([(2, "up", 3)], "id int, term string, tf long")
    w = spark.createDataFrame([("up", 0.5)], "term string, weight double")
    got = {r.id: (r.pn, r.ratio) for r in SE.bow_score(docs, tf, w).collect()}
    assert got[1] == ("N", 50.0) and got[2][0] == "P" and got[2][1] == 81.76


def test_vocabulary_ties_by_token(spark):
    df = spark.createDataFrame([(1, "b a c a"), (2, "c b")], "id int, t string").withColumn(
        "tokens", FE.tokenise("t"))
    got = [(r.token, r.cnt) for r in FE.vocabulary(df, k=2).collect()]
    assert got == [("a", 2), ("b", 2)]


def _mod(spark, texts, lex_rows):
    lex = spark.createDataFrame(lex_rows, "word string, tenths long")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return {r.id: r for r in SE.lexicon_sentiment_modified(df, ["id"], "t", lex).collect()}


def _compound(s):
    import math
    return round(max(-1.0, min(1.0, s / math.sqrt(s * s + 15))), 4)


def test_modifiers_match_the_rule(spark):
    lex = [("good", 19), ("bad", -25)]
    got = _mod(spark, ["good", "very good", "not good", "GOOD day", "good!!", "good but bad",
                       "very very good", "plain words", "not very bad??"], lex)
    assert got[0].compound == _compound(1.9)
    assert got[1].compound == _compound(1.9 + 0.293)
    assert got[2].compound == _compound(1.9 * -0.74)
    assert got[3].compound == _compound(1.9 + 0.733)
    assert got[4].compound == _compound(1.9 + 2 * 0.292)
    assert got[5].compound == _compound(1.9 * 0.5 + -2.5 * 1.5)
    assert got[6].compound == _compound(1.9 + 0.293 + 0.293 * 0.95)
    assert (got[7].compound, got[7].neu) == (0.0, 1.0)
    assert got[8].compound == _compound((-2.5 - 0.293) * -0.74 + 2 * 0.18)
    base = _mod(spark, ["good"], lex)[0]
    assert base.pos == 1.0 and base.neg == 0.0


def test_contraction_negates(spark):
    got = _mod(spark, ["good", "isn't good", "isn\u2019t good", "not good"], [("good", 19)])
    score = [got[i].compound for i in range(4)]
    assert score[1] == score[2] == score[3] < 0 < score[0]


def test_frequent_tokens_are_not_dealt_out_and_scores_stay(spark, monkeypatch):
    """One token is a third of all positions: it meets the lexicon by broadcast, and the scores
    are those of the plain join."""
    rows = [(i, ["the"] * 5 + [f"w{(i * 7 + j) % 300}" for j in range(10)] if i % 9 else []) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    lex = spark.createDataFrame([("the", 3)] + [(f"w{i}", i % 41 - 20) for i in range(0, 300, 2)], "word string, tenths long")
    each = df.selectExpr("id", "explode_outer(tokens) AS token")
    frequent = [r.token for r in SE.frequent_tokens(each).collect()]
    assert "the" in frequent and len(frequent) <= SE.SHARES
    got = sorted(map(tuple, SE.lexicon_sentiment(df, ["id"], "tokens", lex).collect()))
    valued = {r.id: r.s for r in SE.with_valence(each, lex).groupBy("id").agg(F.sum("tenths").alias("s")).collect()}
    of = dict(lex.collect())
    assert valued == {i: (sum(of[t] for t in ts if t in of) if any(t in of for t in ts) else None) for i, ts in rows}
    monkeypatch.setattr(SE, "SHARES", 2)  # only a token that is half of all: none
    assert SE.frequent_tokens(each).count() == 0
    assert sorted(map(tuple, SE.lexicon_sentiment(df, ["id"], "tokens", lex).collect())) == got
    monkeypatch.setattr(SE, "SHARES", 10_000)  # every token
    assert sorted(map(tuple, SE.lexicon_sentiment(df, ["id"], "tokens", lex).collect())) == got


def test_corpus_weights_equal_those_by_id_and_term(spark):
    """Repeated ids and null labels included; documents with their own id take no shuffle by (id, term)."""
    from tickerlens.operators import features as FE
    c = spark.createDataFrame([(1, 1, ["a", "a", "b"]), (1, 0, ["c"]), (2, 0, ["a", "d"]), (3, 1, ["b", "b"]), (4, None, ["a"]),
                               (5, 1, []), (6, 1, None), (6, 1, ["b"]), (None, 1, ["a"])], "id long, label int, tokens array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "token string")
    want = SE.weights_from_corpus(FE.term_frequency(c, vocab), c)
    assert sorted(map(tuple, SE.corpus_weights(c, vocab).collect())) == sorted(map(tuple, want.collect()))


def test_scores_need_no_counts_per_document(spark):
    from tickerlens.operators import features as FE
    d = spark.createDataFrame([(1, ["a", "a", "b"]), (2, []), (3, None), (1, ["b"])], "id long, tokens array<string>")
    vocab = spark.createDataFrame([("a",), ("b",)], "token string")
    w = spark.createDataFrame([("a", 0.5), ("b", -0.25)], "term string, weight double")
    want = SE.bow_score(d, FE.term_frequency(d, vocab), w)
    assert sorted(map(tuple, SE.bow_score(d, FE.term_occurrences(d), w).collect())) == sorted(map(tuple, want.collect()))


def test_words_meet_on_heads_of_every_length(spark):
    """Heads of 1 to 16 characters, at the edge of blocks, beyond the basic plane; none left out."""
    pad = "x" * (SE.BLOCK_CHARS - 3)
    words = ["q", "ab", "abc", "hijk", "longerwd", "wordsofmorethan16chars", "\U0001f600z"]
    texts = [w for w in words] + [pad + w for w in words] + ["a b c", "wordsofmorethan16char", "longer wd", "\U0001f600", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    w = spark.createDataFrame([(x,) for x in words], "word string")
    assert max(SE.HEADS) == 16
    got = {r.id: r.has_word for r in SE.contains_any(df, "t", w).collect()}
    assert got == {i: t is not None and any(x in t for x in words) for i, t in enumerate(texts)}

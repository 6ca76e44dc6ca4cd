"""Sentiment scoring (A7 lexicon, A8 bag-of-words score, A9 training, J7 override)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, stored


# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Lexicon normalisation constant (published definition of the compound score).
COMPOUND_ALPHA = 15.0
# Classifier decision: score strictly greater than this -> P.
DECISION_THRESHOLD = 0.5
# Keyword override: contents and words meet on the first of these numbers of characters that a word has.
HEADS = (16, 8, 4, 2, 1)
# Tokens that make up at least one in so many of all tokens meet the lexicon without a shuffle.
# By this measure there are never more such tokens than this number.
SHARES = 500
BLOCK_CHARS = 4096  # contents are cut into grams in blocks of this many characters
# ---------------------------------------------------------------------------


def lexicon_from_corpus(docs: DataFrame, id_col: str = "id", label_col: str = "label",
                        tokens_col: str = "tokens") -> DataFrame:
    """A derived lexicon (word, valence in tenths): valence = floor(40 (p-n)/(p+n)) / 10
    where p / n are the numbers of positive / negative documents holding the word."""
    dt = docs.select(id_col, label_col, F.explode(F.array_distinct(tokens_col)).alias("word"))
    g = dt.groupBy("word").agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("p"),
                               F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).alias("n"))
    tenths = F.floor(F.lit(40) * (F.col("p") - F.col("n")) / (F.col("p") + F.col("n")))
    return g.select("word", tenths.cast("bigint").alias("tenths"))


def frequent_tokens(rows: DataFrame) -> DataFrame:
    """(token): those that are at least one in ``SHARES`` of all tokens of ``rows``."""
    counts = stored(rows.where("token IS NOT NULL").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-counts")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    frequent = stored(counts.where(F.col("n") * SHARES >= total).select("token"), "token-frequent")
    if (found := frequent.count()) > SHARES:
        raise ValueError(f"{found} frequent tokens, at most {SHARES} can be")
    return frequent


def with_valence(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``rows`` (one per token, null for a text without any) with the lexicon's ``tenths``, null
    where it has none. The frequent tokens, a table of bounded size, are broadcast, so a token
    that is a third of all stays where its texts are; no other one is more than one in
    ``SHARES`` of what is dealt out by token. ``rows`` is read several times: store it first."""
    lex = lexicon.select(F.col("word").alias("token"), "tenths")
    frequent = frequent_tokens(rows)
    known = stored(frequent.join(lex, "token", "left").withColumn("frequent", F.lit(True)), "token-valences")
    near = rows.join(F.broadcast(known), "token", "left").where("frequent OR token IS NULL").drop("frequent")
    far = rows.where("token IS NOT NULL").join(F.broadcast(frequent), "token", "left_anti").join(lex, "token", "left")
    return near.unionByName(far)


def lexicon_sentiment(df: DataFrame, id_cols: list[str], tokens_col: str,
                      lexicon: DataFrame) -> DataFrame:
    """A7 (base layer): per text, neg / neu / pos shares (3 decimals) and the
    compound score S / sqrt(S^2 + 15) clipped to [-1, 1] (4 decimals), where
    each token contributes its lexicon valence (0 when absent). Valences are
    summed as integer tenths, so the result does not depend on summation order.
    A text without tokens scores 0 everywhere."""
    texts = stored(df.select(*id_cols, F.col(tokens_col).alias("tokens")), "lexicon-texts")
    t = with_valence(texts.select(*id_cols, F.explode_outer("tokens").alias("token")), lexicon).withColumn(
        "t", F.when(F.col("token").isNotNull(), F.coalesce("tenths", F.lit(0))))
    g = t.groupBy(*id_cols).agg(
        F.sum("t").alias("s10"),
        F.sum(F.when(F.col("t") > 0, F.col("t") + 10)).alias("pos10"),
        F.sum(F.when(F.col("t") < 0, F.col("t") - 10)).alias("neg10"),
        F.count(F.when(F.col("t") == 0, 1)).alias("neu_n"))
    s = F.coalesce(F.col("s10"), F.lit(0)) / 10.0
    pos = F.coalesce(F.col("pos10"), F.lit(0)) / 10.0
    neg = F.coalesce(F.col("neg10"), F.lit(0)) / 10.0
    neu = F.coalesce(F.col("neu_n"), F.lit(0)).cast("double")
    total = pos + F.abs(neg) + neu
    comp = s / F.sqrt(s * s + F.lit(COMPOUND_ALPHA))
    comp = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), comp))
    share = lambda x: F.when(total > 0, F.round(F.abs(x / total), 3)).otherwise(F.lit(0.0))
    return g.select(*id_cols, share(neg).alias("neg"), share(neu).alias("neu"),
                    share(pos).alias("pos"),
                    F.when(F.col("s10").isNull() | (F.col("s10") == 0), F.lit(0.0))
                     .otherwise(F.round(comp, 4)).alias("compound"))


def weights_from_corpus(tf: DataFrame, labels: DataFrame, id_col: str = "id",
                        label_col: str = "label") -> DataFrame:
    """Per-term weight (exact multiple of 1/16): floor(16 (p-n)/(p+n+1)) / 16 over
    document frequencies in positive (p) and negative (n) documents."""
    j = tf.join(labels.select(id_col, label_col), id_col)
    g = j.groupBy("term").agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("p"),
                              F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).alias("n"))
    return _weights(g)


def corpus_weights(corpus: DataFrame, vocab: DataFrame, id_col: str = "id", label_col: str = "label",
                   tokens_col: str = "tokens") -> DataFrame:
    """``weights_from_corpus`` of a tokenised corpus, stored before as it is read several times. A
    document's terms are found in its row and only counted per term; rows that share their id,
    whose terms are those of all of them, take the way by (id, term)."""
    again = stored(corpus.groupBy(id_col).count().where("count > 1").select(id_col), "repeated-ids")
    terms = F.broadcast(vocab.select(F.col("token").alias("term")))
    single = corpus.join(again, id_col, "left_anti").where(F.col(id_col).isNotNull())
    rows = single.select(F.col(label_col).alias("_l"), F.explode_outer(F.array_distinct(tokens_col)).alias("term"))
    shared = corpus.join(again, id_col, "left_semi").select(id_col, label_col, tokens_col)
    more = shared.select(id_col, F.explode(tokens_col).alias("term")).join(terms, "term").distinct()
    rows = rows.join(terms, "term").select("_l", "term").unionByName(
        more.join(shared.select(id_col, F.col(label_col).alias("_l")), id_col).select("_l", "term"))
    return _weights(rows.groupBy("term").agg(F.sum(F.when(F.col("_l") == 1, 1).otherwise(0)).alias("p"),
                                             F.sum(F.when(F.col("_l") == 1, 0).otherwise(1)).alias("n")))


def _weights(counted: DataFrame) -> DataFrame:
    w = F.floor(F.lit(16) * (F.col("p") - F.col("n")) / (F.col("p") + F.col("n") + 1)) / 16.0
    return counted.select("term", w.alias("weight"))


def bow_score(docs: DataFrame, tf: DataFrame, weights: DataFrame, id_col: str = "id",
              bias: float = 0.0) -> DataFrame:
    """s = sigmoid(sum(tf * w) + bias); s > 0.5 -> P with ratio s*100, else N
    with (1-s)*100, both rounded to 2 decimals. Every row of ``docs`` is scored
    (no vocabulary term -> s = 0.5 -> N, 50.0)."""
    z = (tf.join(weights, "term").groupBy(id_col)
         .agg(F.sum(F.col("tf") * F.col("weight")).alias("z")))
    j = docs.select(id_col).join(z, id_col, "left")
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.coalesce(F.col("z"), F.lit(0.0)) + F.lit(bias))))
    out = j.withColumn("score", s)
    pos = F.col("score") > DECISION_THRESHOLD
    return out.select(id_col,
                      F.when(pos, F.lit("P")).otherwise(F.lit("N")).alias("pn"),
                      F.when(pos, F.round(F.col("score") * 100, 2))
                       .otherwise(F.round((1 - F.col("score")) * 100, 2)).alias("ratio"))


# --- J7 keyword override -----------------------------------------------------

def _runs(block, n: int) -> "F.Column":
    """array of the distinct runs of ``n`` characters in the block, wherever they start."""
    return F.array_distinct(F.regexp_extract_all(block, F.lit(rf"(?s)(?=(.{{{n}}}))"), 1))


def contains_any(df: DataFrame, content_col: str, words: DataFrame, word_col: str = "word",
                 out_col: str = "has_word") -> DataFrame:
    """Existence of any dictionary word as a case-sensitive substring of the content, one
    exact plan for every dictionary size.

    A word's head is its longest start of 1, 2, 4 .. ``HEADS[0]`` characters. The distinct runs
    of the lengths that heads have, keyed by the content's 128-bit hash, are equi-joined with
    the heads; only for the pairs found is the text joined back by its hash and searched for the
    whole word. No word is collected, and no text is copied per run. An empty word is in every
    non-null content. ``df`` is stored once, as it is read three times."""
    df = stored(df, "contents")
    w = words.select(F.col(word_col).alias("_w")).where(F.col("_w").isNotNull()).distinct()
    c = F.col(content_col)
    keys = [F.xxhash64(c).alias("_k1"), F.xxhash64(F.lit(1), c).alias("_k2")]
    texts = df.where(c.isNotNull()).select(*keys, c.alias("_c"))
    size = F.coalesce(*[F.when(F.length("_w") >= n, F.lit(n)) for n in HEADS])
    heads = stored(w.where(F.length("_w") > 0).select(F.substring(F.col("_w"), F.lit(1), size).alias("_g"), "_w", size.alias("_n")), "word-heads")
    sizes = [r[0] for r in heads.select("_n").distinct().orderBy("_n").collect()]  # at most len(HEADS)
    blocks = F.regexp_extract_all(F.col("_c"), F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), 0)
    reach = max(sizes, default=1) - 1  # a block takes the start of the next one along
    longer = F.transform(blocks, lambda b, i: F.concat(b, F.coalesce(F.substring(F.get(blocks, i + 1), 1, reach), F.lit(""))))
    # equal contents are cut once; few bytes of contents are one task, but many runs
    block = spread(texts.distinct()).select("_k1", "_k2", F.explode_outer(F.when(F.length("_c") > BLOCK_CHARS, longer).otherwise(F.array("_c"))).alias("_b"))
    runs = F.concat(*[_runs(F.col("_b"), n) for n in sizes]) if sizes else F.array().cast("array<string>")
    grams = block.select("_k1", "_k2", F.explode_outer(runs).alias("_g"))
    pairs = grams.join(heads.drop("_n"), "_g").select("_k1", "_k2", "_w").distinct()
    hits = (texts.join(pairs, ["_k1", "_k2"]).where(F.contains("_c", F.col("_w")))
            .select("_k1", "_k2").distinct().withColumn("_hit", F.lit(True)))
    empty = F.coalesce(w.agg(F.max(F.length("_w") == 0)).scalar(), F.lit(False))  # one value
    out = df.select("*", *keys).join(hits, ["_k1", "_k2"], "left")
    return (out.withColumn(out_col, c.isNotNull() & (F.coalesce("_hit", F.lit(False)) | empty))
            .select(*df.columns, out_col))


def keyword_override(df: DataFrame, label_col: str, content_col: str, words: DataFrame,
                     word_col: str = "word", out_col: str = "pn_final") -> DataFrame:
    """Classifier label P -> N when any negative word is contained, else P;
    label N -> N when any is contained, else C. An empty dictionary leaves the
    label unchanged. Case-sensitive substring; the word's language is ignored."""
    flagged = contains_any(df, content_col, words, word_col, "_has")
    known = words.where(F.col(word_col).isNotNull()).agg(F.count(F.lit(1)) > 0).scalar()
    lab = F.col(label_col)
    res = (F.when(~known, lab).when(F.col("_has"), F.lit("N"))
           .when(lab == "P", F.lit("P"))
           .when(lab.isNotNull(), F.lit("C")))
    return flagged.withColumn(out_col, res).drop("_has")


def bow_train(corpus: DataFrame, text_col: str = "document", label_col: str = "label",
              vocab_size: int = 5000, max_iter: int = 20):
    """Fit CountVectorizer + LogisticRegression (distributed, Spark ML)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, RegexTokenizer

    tok = RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=r"\p{L}+", gaps=False,
                         toLowercase=True)
    cv = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=vocab_size)
    lr = LogisticRegression(featuresCol="features", labelCol="label_d", maxIter=max_iter)
    data = corpus.withColumn("label_d", F.col(label_col).cast("double"))
    return Pipeline(stages=[tok, cv, lr]).fit(data)


# --- A7 modifier layer --------------------------------------------------------
# Fixed values of the published rule set (Hutto & Gilbert 2014); the word lists
# are parameters with these defaults.
B_INCR, B_DECR = 0.293, -0.293      # booster / dampener step
C_INCR = 0.733                      # ALL-CAPS emphasis
N_SCALAR = -0.74                    # negation within three preceding tokens
DAMP = (1.0, 0.95, 0.9)             # booster weight at distance 1, 2, 3
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCL_STEP, EXCL_MAX = 0.292, 4
QM_STEP, QM_MAX_SMALL, QM_BIG = 0.18, 3, 0.96
BOOSTERS_UP = ("absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly",
               "deeply", "enormously", "entirely", "especially", "exceptionally", "extremely",
               "fabulously", "greatly", "highly", "hugely", "incredibly", "intensely", "majorly",
               "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so",
               "substantially", "thoroughly", "totally", "tremendously", "uber", "unbelievably",
               "unusually", "utterly", "very")
BOOSTERS_DOWN = ("almost", "barely", "hardly", "kinda", "less", "little", "marginally",
                 "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta")
NEGATIONS = ("aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt",
             "hasnt", "havent", "isnt", "neither", "never", "none", "nope", "nor", "not", "nothing",
             "nowhere", "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt", "rarely",
             "seldom", "despite")


def _arr(words):
    return F.array(*[F.lit(w) for w in words])


def lexicon_sentiment_modified(df: DataFrame, id_cols: list[str], text_col: str, lexicon: DataFrame,
                               boosters_up=BOOSTERS_UP, boosters_down=BOOSTERS_DOWN,
                               negations=NEGATIONS) -> DataFrame:
    """A7 with the modifier layer. Per token (case kept, letter runs): boosters
    in the three preceding tokens add +/-0.293 (x0.95, x0.9 with distance,
    sign following the word's valence, +/-0.733 more when the booster is in
    capitals and the text mixes cases); a negation among the three preceding
    tokens multiplies by -0.74 (once per negation); an ALL-CAPS word in a
    mixed-case text moves by 0.733; words before the first 'but' x0.5, after
    x1.5. '!' adds 0.292 each (at most 4) and two or more '?' add 0.18 each (up
    to 3) or 0.96, in the direction of the sum; shares and compound as in the
    base layer. Booster words themselves score 0.

    Neighbour features come from the in-row token array (fixed word lists) and are
    stored per text, so only the lexicon's join and one aggregation per text are left."""
    up, down, neg = _arr(boosters_up), _arr(boosters_down), _arr(negations)
    is_caps = lambda t: (t == F.upper(t)) & (t != F.lower(t))
    txt = F.col(text_col)
    # an apostrophe inside a word goes, so that a contraction ("isn't") is one token of the lists
    joined = F.regexp_replace(txt, r"(?<=\p{L})['\u2019](?=\p{L})", "")
    # per-text values first (columns), so the per-token lambda only reads them
    s1 = df.select(*id_cols, F.regexp_extract_all(joined, F.lit(r"\p{L}+"), 0).alias("_toks"),
                   (F.length(txt) - F.length(F.replace(txt, F.lit("!"), F.lit("")))).alias("n_excl"),
                   (F.length(txt) - F.length(F.replace(txt, F.lit("?"), F.lit("")))).alias("n_qm"))
    n_caps = F.size(F.filter("_toks", is_caps))
    s2 = s1.select("*", ((n_caps > 0) & (n_caps < F.size("_toks"))).alias("_capdiff"),
                   F.array_position(F.transform("_toks", lambda t: F.lower(t)), "but").alias("_but"))
    toks, cap_diff, but_at = F.col("_toks"), F.col("_capdiff"), F.col("_but")

    def feat(t, i):
        def boost(d):
            p = F.get(toks, i - d)
            pl = F.lower(p)
            step = (F.when(F.array_contains(up, pl), F.lit(B_INCR))
                    .when(F.array_contains(down, pl), F.lit(B_DECR)).otherwise(F.lit(0.0)))
            step = F.when((step != 0) & is_caps(p) & cap_diff,
                          F.when(step > 0, step + C_INCR).otherwise(step - C_INCR)).otherwise(step)
            return F.when(i >= d, step * DAMP[d - 1]).otherwise(F.lit(0.0))

        def negd(d):
            return F.when((i >= d) & F.array_contains(neg, F.lower(F.get(toks, i - d))), 1).otherwise(0)
        return F.struct(
            F.lower(t).alias("token"), i.alias("i"),
            (F.array_contains(up, F.lower(t)) | F.array_contains(down, F.lower(t))).alias("is_booster"),
            (is_caps(t) & cap_diff).alias("caps"),
            (boost(1) + boost(2) + boost(3)).alias("boost"),
            (negd(1) + negd(2) + negd(3)).alias("negs"),
            F.when(but_at == 0, F.lit(1.0)).when(i + 1 < but_at, F.lit(BUT_BEFORE))
             .when(i + 1 > but_at, F.lit(BUT_AFTER)).otherwise(F.lit(1.0)).alias("but"))

    feats = stored(s2.select(*id_cols, F.transform(toks, feat).alias("fs"), "n_excl", "n_qm"), "lexicon-features")
    each = feats.select(*id_cols, F.explode_outer("fs").alias("f"), "n_excl", "n_qm").select(*id_cols, "f.*", "n_excl", "n_qm")
    j = with_valence(each, lexicon).withColumn("base", F.col("tenths") / 10.0)
    b = F.when(F.col("is_booster"), F.lit(0.0)).otherwise(F.coalesce("base", F.lit(0.0)))
    v = F.when(b == 0, F.lit(0.0)).otherwise(
        b + F.when(F.col("caps"), F.when(b > 0, F.lit(C_INCR)).otherwise(F.lit(-C_INCR))).otherwise(0.0))
    v = F.when(v == 0, v).otherwise(v + F.when(v > 0, F.col("boost")).otherwise(-F.col("boost")))
    v = v * F.pow(F.lit(N_SCALAR), F.col("negs")) * F.col("but")
    scored = j.withColumn("v", F.when(F.col("token").isNotNull(), v))
    g = scored.groupBy(*id_cols).agg(
        F.sum("v").alias("s"), F.sum(F.when(F.col("v") > 0, F.col("v") + 1)).alias("pos_sum"),
        F.sum(F.when(F.col("v") < 0, F.col("v") - 1)).alias("neg_sum"),
        F.count(F.when(F.col("v") == 0, 1)).alias("neu_n"), F.first("n_excl").alias("n_excl"),
        F.first("n_qm").alias("n_qm"))
    ep = F.least(F.col("n_excl"), F.lit(EXCL_MAX)) * EXCL_STEP
    qm = (F.when(F.col("n_qm") > QM_MAX_SMALL, F.lit(QM_BIG))
          .when(F.col("n_qm") > 1, F.col("n_qm") * QM_STEP).otherwise(F.lit(0.0)))
    punct = ep + qm
    s = F.coalesce(F.col("s"), F.lit(0.0))
    s_adj = F.when(s > 0, s + punct).when(s < 0, s - punct).otherwise(s)
    pos = F.coalesce(F.col("pos_sum"), F.lit(0.0))
    neg_ = F.coalesce(F.col("neg_sum"), F.lit(0.0))
    pos2 = F.when(pos > F.abs(neg_), pos + punct).otherwise(pos)
    neg2 = F.when(pos < F.abs(neg_), neg_ - punct).otherwise(neg_)
    neu = F.col("neu_n").cast("double")
    total = pos2 + F.abs(neg2) + neu
    comp = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s_adj / F.sqrt(s_adj * s_adj + F.lit(COMPOUND_ALPHA))))
    share = lambda x: F.when(total > 0, F.round(F.abs(x / total), 3)).otherwise(F.lit(0.0))
    return g.select(*id_cols, share(neg2).alias("neg"), share(neu).alias("neu"), share(pos2).alias("pos"),
                    F.when(s_adj == 0, F.lit(0.0)).otherwise(F.round(comp, 4)).alias("compound"))

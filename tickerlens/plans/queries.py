"""Registered queries: one (spark, sf_dir) -> DataFrame builder per operator.

Each builder reads the driver's tables through ``adapters`` and applies one
operator (or a whole job); the matching DuckDB SQL lives in ``sql.py``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import linking, quotes as Q
from . import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _latest(spark, sf_dir):
    return Q.latest_quote(A.quotes(spark, sf_dir), tiebreak=A.QUOTE_TIEBREAK)


@register("linked_quotes")
def linked_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship slice: headlines linked to companies (J1) with the latest quote (W1+J8)."""
    linked = linking.link_headlines(A.headlines(spark, sf_dir), A.master(spark, sf_dir))
    out = Q.attach_quote(linked, _latest(spark, sf_dir))
    return out.select("seq", F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
                      "code", "name", "content", *Q.QUOTE_VALUES)


# --- scalars (P1-P22) ------------------------------------------------------
from ..functions import language as L  # noqa: E402
from ..functions import text as T  # noqa: E402
from ..functions.formats import with_keys  # noqa: E402
from ..session import read_table, spread, stored  # noqa: E402


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


@register("clean_text")
def q_clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.clean_text("text").alias("cleaned"))


@register("headline_key")
def q_headline_key(spark, sf_dir):
    return A.headlines(spark, sf_dir).select("seq", T.headline_key("title").alias("key"),
                                             T.strip_hyphen("title").alias("content"))


@register("extract_ticker")
def q_extract_ticker(spark, sf_dir):
    """P4 over headlines and documents: no '(' -> dropped; ticker longer than 4 -> dropped."""
    h = A.headlines(spark, sf_dir).select(F.lit("headline").alias("src"), F.col("seq").alias("id"),
                                          F.col("title").alias("text"))
    d = _docs(spark, sf_dir).select(F.lit("document").alias("src"), F.col("doc_id").alias("id"), "text")
    from ..operators.usjob import extract_ticker
    return extract_ticker(h.unionByName(d), "text").select("src", "id", "ticker")


@register("truncate_words")
def q_truncate_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.truncate_words("text", 20).alias("truncated"))


@register("normalise_ws")
def q_normalise_ws(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.normalise_ws("text").alias("normalised"))


@register("section_after")
def q_section_after(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.section_after("text", ". ").alias("section"))


@register("keep_alnum_hangul")
def q_keep_alnum_hangul(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.keep_alnum_hangul("text").alias("kept"))


@register("last_paragraph")
def q_last_paragraph(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.last_paragraph("text", "\n").alias("last_block"))


@register("detect_language")
def q_detect_language(spark, sf_dir):
    r = A.replies(spark, sf_dir)
    return r.select("seq", L.is_korean("reply").alias("is_korean"),
                    L.is_english("reply").alias("is_english"),
                    L.detect_language("reply").alias("language"))


@register("verdict_pn")
def q_verdict_pn(spark, sf_dir):
    return A.replies(spark, sf_dir).select("seq", "reply", L.verdict("reply", "P").alias("pn"))


@register("verdict_pnc")
def q_verdict_pnc(spark, sf_dir):
    return A.replies(spark, sf_dir).select("seq", "reply", L.verdict("reply", "C").alias("pnc"))


@register("sentences_findall")
def q_sentences_findall(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.size(T.sentences("text")).cast("bigint").alias("n_sentences"),
                    T.first_sentence("text").alias("first_sentence"))


@register("sentences_split")
def q_sentences_split(spark, sf_dir):
    """P16 (look-behind split); the oracle tests each position instead of using look-behind."""
    c = read_table(spark, sf_dir, "conversations")
    out = c.select("conv_id", "turn", F.posexplode(T.sentence_split("text")).alias("pos", "sentence"))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@register("format_numbers")
def q_format_numbers(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_extendedprice", T.fmt_int("l_extendedprice").alias("price_text"),
                     T.fmt_int(F.col("l_extendedprice") * -7.5).alias("neg_text"))


@register("parse_share_count")
def q_parse_share_count(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    rendered = F.concat(T.fmt_int(F.col("o_totalprice") * 100), F.lit("/ "), F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", T.parse_shares(rendered).alias("shares"))


@register("run_keys")
def q_run_keys(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", F.format_string("%06d", F.col("user_id")).alias("code"))
    return with_keys(e, F.col("ts")).select("event_id", "key_", "detail_key", "date_", "time_")


@register("error_report_predicates")
def q_error_report_predicates(spark, sf_dir):
    from ..operators.store import ERROR_PATTERN, FAILURE_MARK
    s = A.store_all(spark, sf_dir)
    return s.select("seq", (~F.col("report_").contains(FAILURE_MARK)).alias("reusable"),
                    F.col("report_").rlike(ERROR_PATTERN).alias("purge"))


# --- joins, sets, windows (J2-J5, A1, A2, W2, W3, S11) ----------------------
from ..operators import pages as PG  # noqa: E402
from ..operators import store as ST  # noqa: E402
from ..sources.crawl import crawl_plan  # noqa: E402


def _day(c="run_date"):
    return F.date_format(c, "yyyy-MM-dd")


@register("link_candidates")
def q_link_candidates(spark, sf_dir):
    h = A.headlines(spark, sf_dir).withColumn("key", T.headline_key("title"))
    cand = linking.candidate_counts(h, A.master(spark, sf_dir))
    return h.join(cand, "key").select("seq", "key", "n_candidates")


@register("link_carry_forward")
def q_link_carry_forward(spark, sf_dir):
    out = linking.link_with_legacy_carry(A.headlines(spark, sf_dir), A.master(spark, sf_dir),
                                         chunk_rows=1000)
    return out.select("seq", _day().alias("run_date"), "key", "code", "name", "exact")


def _linked(spark, sf_dir):
    return linking.link_headlines(A.headlines(spark, sf_dir), A.master(spark, sf_dir))


@register("new_only")
def q_new_only(spark, sf_dir):
    l = _linked(spark, sf_dir).withColumn("run_day", _day())
    out = linking.new_only(l, A.store(spark, sf_dir), [("code", "code_"), ("run_day", "date_")])
    return out.select("seq", "code", "run_day")


@register("reuse_reports")
def q_reuse_reports(spark, sf_dir):
    out = ST.reuse_reports(_linked(spark, sf_dir), A.store(spark, sf_dir))
    return out.select("seq", "code", "report", "needs_report")


@register("count_by_code_date")
def q_count_by_code_date(spark, sf_dir):
    return ST.count_by_code_date(A.store_all(spark, sf_dir))


@register("max_report")
def q_max_report(spark, sf_dir):
    return ST.max_report(A.store_all(spark, sf_dir))


@register("dedupe_pages")
def q_dedupe_pages(spark, sf_dir):
    """W3 with each document as a list of its lines: equal line lists -> first doc kept."""
    d = _docs(spark, sf_dir)
    items = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "title"))
    _, kept = PG.dedupe_pages(items, ["doc_id"], [F.col("doc_id")])
    return kept.select("doc_id", F.col("n").cast("bigint").alias("n_lines"))


@register("dedupe_headline_lists")
def q_dedupe_headline_lists(spark, sf_dir):
    """W3 on the headline page lists, first seen = newest day, then page, then slot."""
    h = A.headlines(spark, sf_dir)
    kept_items, _ = PG.dedupe_pages(h, ["run_date", "page_no", "slot"],
                                    [F.datediff(F.lit("2100-01-01"), "run_date"), F.col("page_no"),
                                     F.col("slot")])
    return kept_items.select("seq", _day().alias("run_date"), "page_no", "slot", "pos")


def _backfill(spark, sf_dir, n):
    h = A.headlines(spark, sf_dir)
    out = PG.backfill_horizon(h, ["run_date", "page_no", "slot"], min_lists=n)
    return out.select(_day().alias("run_date"), "new_lists", "lists_before", "lists_held")


@register("backfill_horizon")
def q_backfill_horizon(spark, sf_dir):
    return _backfill(spark, sf_dir, 10)


@register("backfill_horizon_wide")
def q_backfill_horizon_wide(spark, sf_dir):
    return _backfill(spark, sf_dir, 200)


@register("crawl_plan")
def q_crawl_plan(spark, sf_dir):
    out = crawl_plan(A.headlines(spark, sf_dir), slots=("dd", "dt"))
    return out.select(_day().alias("run_date"), F.col("page_no").cast("bigint").alias("page_no"), "slot")


# --- features and sentiment (A3-A9, J7, S6) ---------------------------------
from ..operators import features as FE  # noqa: E402
from ..operators import sentiment as SE  # noqa: E402
from . import jobs as J  # noqa: E402


def _corpus_tokens(spark, sf_dir):
    return A.corpus(spark, sf_dir).withColumn("tokens", FE.tokenise("document"))


def _doc_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "text",
                                       FE.tokenise("text").alias("tokens"))


@register("tokenise")
def q_tokenise(spark, sf_dir):
    d = _doc_tokens(spark, sf_dir)
    return d.select("id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


@register("vocab_top_k")
def q_vocab_top_k(spark, sf_dir):
    return FE.vocabulary(_corpus_tokens(spark, sf_dir))


@register("term_frequency")
def q_term_frequency(spark, sf_dir):
    c = _corpus_tokens(spark, sf_dir)
    counts = FE.token_counts(c)
    return FE.term_frequency(c, FE.vocabulary(c, counts=counts), counts=counts)


def _bow(spark, sf_dir):
    model = J.bow_model(A.corpus(spark, sf_dir))
    d = _doc_tokens(spark, sf_dir)
    return d, SE.bow_score(d, FE.term_occurrences(d), model.weights)


@register("bow_score")
def q_bow_score(spark, sf_dir):
    return _bow(spark, sf_dir)[1]


@register("bow_score_stored")
def q_bow_score_stored(spark, sf_dir):
    """A8 with a stored model: the first run fits and stores it, the second loads it and scores."""
    root, corpus = _store_dir(spark, "bow_models"), A.corpus(spark, sf_dir)
    for _ in range(2):
        model = J.bow_model(corpus, root)
    d = _doc_tokens(spark, sf_dir)
    return SE.bow_score(d, FE.term_occurrences(d), model.weights)


@register("bow_loss")
def q_bow_loss(spark, sf_dir):
    """The stored model's mean logistic loss on the corpus it was fitted on."""
    from ..operators.models import log_loss
    corpus = A.corpus(spark, sf_dir)
    model = J.bow_model(corpus, _store_dir(spark, "bow_models"))
    tf = FE.term_frequency(_corpus_tokens(spark, sf_dir), model.vocab)
    z = tf.join(model.weights, "term").groupBy("id").agg(F.sum(F.col("tf") * F.col("weight")).alias("z"))
    return log_loss(corpus.join(z, "id", "left").select(F.coalesce("z", F.lit(0.0)).alias("z"), "label"))


def negative_words(spark, sf_dir):
    """Derived dictionary: tokens found only in toxic documents, in at least two."""
    d = _docs(spark, sf_dir).join(read_table(spark, sf_dir, "labels"), "doc_id")
    t = d.select("doc_id", "toxic", F.explode(F.array_distinct(FE.tokenise("text"))).alias("word"))
    g = t.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("tox"),
                              F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("clean"))
    words = g.where((F.col("tox") >= 2) & (F.col("clean") == 0)).select(
        F.col("word").alias("nag_word"), F.lit("en").alias("lang"))
    return stored(words, "nag-words")  # a stored table, as the job reads it


@register("keyword_override")
def q_keyword_override(spark, sf_dir):
    d, scored = _bow(spark, sf_dir)
    j = scored.join(d.select("id", "text"), "id")
    out = SE.keyword_override(j, "pn", "text", negative_words(spark, sf_dir), "nag_word")
    return out.select("id", "pn", "pn_final")


@register("lexicon_sentiment")
def q_lexicon_sentiment(spark, sf_dir):
    lex = SE.lexicon_from_corpus(_corpus_tokens(spark, sf_dir))
    conv = read_table(spark, sf_dir, "conversations").withColumn("tokens", FE.tokenise("text"))
    return SE.lexicon_sentiment(conv, ["conv_id", "turn"], "tokens", lex)


@register("bow_train")
def q_bow_train(spark, sf_dir):
    """A9 (rows-only): Spark ML fit on the labelled corpus, scores for every document."""
    model = SE.bow_train(A.corpus(spark, sf_dir))
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("text").alias("document"))
    from pyspark.ml.functions import vector_to_array
    pred = model.transform(docs)
    p1 = F.get(vector_to_array("probability"), 1)
    return pred.select("id", F.when(p1 > 0.5, "P").otherwise("N").alias("pn"),
                       F.round(F.greatest(p1, 1 - p1) * 100, 2).alias("ratio"))


@register("token_doc_cache")
def q_token_doc_cache(spark, sf_dir):
    from ..session import scratch_path
    path = scratch_path(spark, "token_docs")
    c = A.corpus(spark, sf_dir)
    first = FE.cached_tokens(spark, c, path, ["id"], "document", ["label"])
    again = FE.cached_tokens(spark, c, path, ["id"], "document", ["label"])  # read path
    return again.select("id", "label", F.array_join("tokens", " ").alias("tokens_text"))


# --- page scans and valuation (S1-S4, S10, V1-V5, A6) -----------------------
from ..operators import valuation as V  # noqa: E402
from ..sources import html as H  # noqa: E402
from . import company_pages as CP  # noqa: E402


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages")


@register("anchor_attr_scan")
def q_anchor_attr_scan(spark, sf_dir):
    out = H.anchor_attrs(_pages(spark, sf_dir), "href", containers=("dd", "dt", "li"))
    return out.select("page_id", "slot", F.col("pos").cast("bigint").alias("pos"), "value")


@register("class_text_scan")
def q_class_text_scan(spark, sf_dir):
    out = H.class_text(_pages(spark, sf_dir), "div", "ad")
    return out.select("page_id", F.col("pos").cast("bigint").alias("pos"), "text")


@register("company_profile")
def q_company_profile(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", *V.company_profile(F.col("html"), ("h1", None), ("li", None),
                                                 ("headline", "summary")))


def _parts(spark, sf_dir):
    """The rows that pages are rendered from. A page is many times its row, so they are dealt out
    before, and no task gets more of them where there are more."""
    part = read_table(spark, sf_dir, "part")
    return spread(part, part.count())


def listing_pages(spark, sf_dir):
    return _parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), CP.html_column(CP.listing_html_pieces()).alias("html"))


def company_pages(spark, sf_dir):
    return _parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), F.format_string("%06d", "p_partkey").alias("code"),
        CP.html_column(CP.company_html_pieces()).alias("html"))


def filed_pages(spark, sf_dir):
    """Company pages as filed: every 17th under another code, so its company has no page."""
    k = F.col("page_id")
    code = F.format_string("%06d", F.when(k % 17 == 0, k + 900000).otherwise(k))
    return company_pages(spark, sf_dir).withColumn("code", code)


@register("html_table_scan")
def q_html_table_scan(spark, sf_dir):
    c = H.html_tables(listing_pages(spark, sf_dir))
    return c.select("page_id", *[F.col(x).cast("bigint").alias(x) for x in ("table_no", "row_no", "col_no")],
                    "header", "cell")


@register("cell_lookup")
def q_cell_lookup(spark, sf_dir):
    cells = H.html_tables(listing_pages(spark, sf_dir))
    spec = {c: (0, 0, c) for c in CP.LISTING_COLS[1:]}
    spec["size_by_index"] = (0, 0, 4)
    return H.cells_to_fields(cells, spec)


def _index_pages(spark, sf_dir, css_class: str, cells: list):
    """An index page per customer: a table with one row per order (by key), after another
    table of a different class. A cell is a column, null when the row lacks it."""
    def td(c):
        return F.coalesce(F.concat(F.lit("<td>"), c.cast("string"), F.lit("</td>")), F.lit(""))

    row = F.concat(F.lit("<tr>"), *[td(c) for c in cells], F.lit("</tr>"))
    rows = (read_table(spark, sf_dir, "orders").select("o_custkey", F.struct("o_orderkey", row.alias("row")).alias("r"))
            .groupBy(F.col("o_custkey").alias("page_id")).agg(F.sort_array(F.collect_list("r"))["row"].alias("rows")))
    html = F.concat(F.lit('<table class="note"><tr><td>1-URGENT</td><td>1-URGENT</td><td><a href="/no">x</a></td><td>y</td></tr></table>'
                          f'<table class="{css_class}" summary="x"><tr><th>A</th><th>B</th><th>C</th></tr>'),
                    F.array_join("rows", "\n"), F.lit("</table>"))
    return rows.select("page_id", html.alias("html"))


def _link(path: str, after: str):
    return F.concat(F.lit(f'<a class="l" href="{path}'), F.col("o_orderkey").cast("string"), F.lit(f'.htm">{after}</a>'))


@register("filing_index_pick")
def q_filing_index_pick(spark, sf_dir):
    """S10/W4, first rule: on each index page the first row with > 3 cells and 'URGENT' in
    cell 0; the address that cell 1 links to, with a prefix."""
    o, st = F.col("o_orderkey"), F.col("o_orderstatus")
    pages = _index_pages(spark, sf_dir, "tableFile2", [
        F.col("o_orderpriority"), _link("/Archives/ix?doc=/", "Documents"), st,
        F.when(st != "P", F.col("o_custkey")), F.when(st == "F", o)])
    return H.pick_first(H.html_tables(pages, css_class="tableFile2", links=True), 3, 0, "URGENT", 1, prefix="https://www.sec.gov")


@register("filing_doc_pick")
def q_filing_doc_pick(spark, sf_dir):
    """S10, second rule: first row with > 1 cells and 'URGENT' in cell 1; the address that
    cell 2 links to, with a prefix and 'ix?doc=/' removed."""
    pages = _index_pages(spark, sf_dir, "tableFile", [
        F.col("o_orderkey"), F.col("o_orderpriority"), F.when(F.col("o_orderstatus") != "P", _link("/ix?doc=/Archives/", "page"))])
    return H.pick_first(H.html_tables(pages, css_class="tableFile", links=True), 1, 1, "URGENT", 2, prefix="https://www.sec.gov",
                        drop="ix?doc=/")


@register("stock_master")
def q_stock_master(spark, sf_dir):
    """Listing -> name and six-digit code (never truncated)."""
    return A.master(spark, sf_dir).select("name", "code")


def _detail_pages(spark, sf_dir):
    return V.with_tables(company_pages(spark, sf_dir))


def rate_cells(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.lit(0).cast("bigint").alias("page_id"), F.lit(0).alias("table_no"),
                    F.col("s_suppkey").alias("row_no"), F.lit(3).alias("col_no"),
                    F.lit(V.RATE_COLUMN).alias("header"), F.expr(CP.RATE_CELL).alias("cell"))


@register("market_snapshot")
def q_market_snapshot(spark, sf_dir):
    return V.market_snapshot(_detail_pages(spark, sf_dir), keep=["code"])


@register("consensus")
def q_consensus(spark, sf_dir):
    return V.consensus(_detail_pages(spark, sf_dir), keep=["code"])


@register("required_return")
def q_required_return(spark, sf_dir):
    k, shown = V.required_return(rate_cells(spark, sf_dir))
    p = read_table(spark, sf_dir, "part").select(F.format_string("%06d", "p_partkey").alias("code"))
    return p.select("code", k.alias("k"), shown.alias("srim_revenue_rate"))


@register("srim_valuation")
def q_srim_valuation(spark, sf_dir):
    k, shown = V.required_return(rate_cells(spark, sf_dir))
    p = V.market_snapshot(_detail_pages(spark, sf_dir), keep=["code", "tables"])
    return V.srim(p, k, shown, keep=["code"])


@register("last_valid_period")
def q_last_valid_period(spark, sf_dir):
    """A6 on the long cell form: last non-null, non-NaN period value per
    (page, row) of the financial table; equity over all columns, ROA/ROE over
    the four annual ones."""
    from ..operators.quotes import last_valid
    cells = H.html_tables(company_pages(spark, sf_dir).select("page_id", "html"))
    fin = cells.where((F.col("table_no") == 10) & F.col("row_no").isin(9, 16, 17))
    fin = fin.where((F.col("row_no") == 9) | F.col("col_no").between(1, 4))
    fin = fin.withColumn("v", F.trim("cell").try_cast("double"))
    out = last_valid(fin, ["page_id", "row_no"], "col_no", "v")
    return out.select("page_id", F.col("row_no").cast("bigint").alias("row_no"), "last_value")


# --- whole jobs (Q1-Q4) and sinks (K1-K4, S5-S8) ----------------------------
from . import jobs as J  # noqa: E402


def _job_ko(spark, sf_dir, nlp=True, replies=False):
    model = J.bow_model(A.corpus(spark, sf_dir)) if nlp else None
    words = negative_words(spark, sf_dir) if nlp else None
    return J.job_ko(A.headlines(spark, sf_dir), A.master(spark, sf_dir), A.store(spark, sf_dir),
                    A.quotes(spark, sf_dir), model, words, quote_tiebreak=A.QUOTE_TIEBREAK,
                    replies=A.replies(spark, sf_dir) if replies else None)


@register("job_ko")
def q_job_ko(spark, sf_dir):
    return _job_ko(spark, sf_dir, True)


@register("job_ko_replies")
def q_job_ko_replies(spark, sf_dir):
    """Q1 with model replies: the verdict (P13) is read from each article's reply."""
    return _job_ko(spark, sf_dir, True, replies=True)


@register("job_ko_backfill")
def q_job_ko_backfill(spark, sf_dir):
    """Q1 with look-back (W2): the run of the newest day over stored headlines, going back day by
    day until 200 distinct page lists are held."""
    h = A.headlines(spark, sf_dir).withColumn("run_date", _day())
    root = _store_dir(spark, "headline_days")
    ST.append(h, root, partition_by=["run_date"])
    items = J.look_back_headlines(spark, root, h.schema, min_lists=200)
    return J.job_ko(items, A.master(spark, sf_dir), A.store(spark, sf_dir), A.quotes(spark, sf_dir), J.bow_model(A.corpus(spark, sf_dir)),
                    negative_words(spark, sf_dir), quote_tiebreak=A.QUOTE_TIEBREAK)


@register("report_requests_ko")
def q_report_requests_ko(spark, sf_dir):
    """Q1's requests: one prompt per company of the run's articles that has no reusable report."""
    return J.report_requests_ko(_job_ko(spark, sf_dir, False), filed_pages(spark, sf_dir))


@register("job_ko_light")
def q_job_ko_light(spark, sf_dir):
    return _job_ko(spark, sf_dir, False)


@register("ko_details")
def q_ko_details(spark, sf_dir):
    return J.details(_job_ko(spark, sf_dir, False), filed_pages(spark, sf_dir), rate_cells(spark, sf_dir))


def _us_lexicon(spark, sf_dir):
    return SE.lexicon_from_corpus(_corpus_tokens(spark, sf_dir))


@register("job_us")
def q_job_us(spark, sf_dir):
    return J.job_us(A.us_articles(spark, sf_dir), A.us_store(spark, sf_dir),
                    A.us_company_pages(spark, sf_dir), _us_lexicon(spark, sf_dir))


@register("job_us_stored")
def q_job_us_stored(spark, sf_dir):
    """Q2 with its sink: the stored US rows after the run, without error reports."""
    us = q_job_us(spark, sf_dir)
    root = _store_dir(spark, "run_us")
    J.run_us_job(us, root)
    return ST.read_store(spark, root, schema=us.schema).select(*J.US_COLUMNS)


@register("report_requests")
def q_report_requests(spark, sf_dir):
    return J.report_requests(A.us_articles(spark, sf_dir), A.us_store(spark, sf_dir), A.us_company_pages(spark, sf_dir))


@register("bow_train_scores")
def q_bow_train_scores(spark, sf_dir):
    """A9's invariants: every document has a label and a ratio between 50 and 100."""
    r = q_bow_train(spark, sf_dir)
    return r.select("id", (F.col("pn").isin("P", "N") & F.col("ratio").between(50.0, 100.0)).alias("valid"))


@register("filing_digest_requests")
def q_filing_digest_requests(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return J.filing_requests(d, "source", "text", delimiter=". ").select("doc_id", "prompt")


def _store_dir(spark, name):
    from ..session import scratch_path
    return scratch_path(spark, name)


@register("append_predictions")
def q_append_predictions(spark, sf_dir):
    """K1: append the fact (partitioned by date_), read the stored rows back."""
    fact = _job_ko(spark, sf_dir, True)
    root = _store_dir(spark, "prediction_pn")
    ST.append(fact, root, partition_by=["date_"])
    return ST.read_store(spark, root, schema=fact.schema).select(*J.FACT_COLUMNS)


@register("append_details")
def q_append_details(spark, sf_dir):
    """K2: details rendered to strings, appended, read back."""
    det = J.details(_job_ko(spark, sf_dir, False), filed_pages(spark, sf_dir), rate_cells(spark, sf_dir))
    root = _store_dir(spark, "prediction_detail_ko")
    ST.append(det, root)
    return ST.read_store(spark, root, schema=det.schema)


@register("append_us")
def q_append_us(spark, sf_dir):
    us = q_job_us(spark, sf_dir)
    root = _store_dir(spark, "prediction_pn_us")
    ST.append(us, root, sort_by=["date_", "ticker"])
    return ST.read_store(spark, root, schema=us.schema).select(*J.US_COLUMNS)


@register("purge_error_reports")
def q_purge_error_reports(spark, sf_dir):
    """K4: store rows, then delete rows whose report matches 'Error|에러' as a new
    version; running the purge twice changes nothing (idempotent)."""
    s = A.store_all(spark, sf_dir)
    root = _store_dir(spark, "prediction_pn_purge")
    ST.append(s, root, partition_by=["date_"])
    ST.purge(spark, root, s.schema, ["date_"])
    ST.purge(spark, root, s.schema, ["date_"])
    return ST.read_store(spark, root, schema=s.schema).select("seq", "code_", "date_", "report_")


@register("table_scan")
def q_table_scan(spark, sf_dir):
    """Stored table read with projection and a predicate on the partition column."""
    s = A.store_all(spark, sf_dir)
    root = _store_dir(spark, "store_scan")
    ST.append(s, root, partition_by=["date_"])
    return ST.read_store(spark, root, columns=["seq", "code_", "report_"],
                         where=F.col("date_") >= "2024-01-15", schema=s.schema)


@register("tsv_corpus_scan")
def q_tsv_corpus_scan(spark, sf_dir):
    """The labelled corpus written as TSV with a header line, read back."""
    from ..sources.files import read_corpus, write_corpus
    path = _store_dir(spark, "corpus_tsv")
    write_corpus(A.corpus(spark, sf_dir), path)
    return read_corpus(spark, path)


@register("target_list_scan")
def q_target_list_scan(spark, sf_dir):
    """Target list CSV (ticker, price, target_price) derived from customers, read back."""
    from ..sources.files import read_targets
    c = read_table(spark, sf_dir, "customer")
    t = c.select(F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
                 F.col("c_acctbal").alias("price"), (F.col("c_acctbal") * 1.1).alias("target_price"))
    path = _store_dir(spark, "targets_csv")
    t.write.option("header", True).csv(path)
    return read_targets(spark, path)


def _folder(bad):
    """Quarantined lines with the folder of their file; file names differ between runs."""
    return bad.select("line", "reason", F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("folder"))


@register("corpus_quarantine")
def q_corpus_quarantine(spark, sf_dir):
    """The labelled corpus, and files of broken lines beside it: how many good rows there
    are of each label (folder 'good'), and each rejected line with reason and folder."""
    from ..sources.files import scan_corpus, write_corpus
    path = _store_dir(spark, "corpus_mixed")
    write_corpus(A.corpus(spark, sf_dir), f"{path}/good")
    d = read_table(spark, sf_dir, "documents")
    k, i = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    line = (F.when(k == 0, F.concat(i, F.lit("\tonly"))).when(k == 1, F.concat(i, F.lit("\ta\t1\tb"))).when(k == 2, F.concat(i, F.lit("\ta\t7")))
            .when(k == 3, F.lit(" \ta\t1")).otherwise(F.concat(i, F.lit("\ta\ufffd\t1"))))
    d.select(line.alias("value")).write.text(f"{path}/broken")
    good, bad = scan_corpus(spark, path)
    held = good.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat("label", F.lit(": "), F.col("n").cast("string")).alias("line"), F.lit("good").alias("reason"), F.lit("good").alias("folder"))
    return held.unionByName(_folder(bad))


@register("target_quarantine")
def q_target_quarantine(spark, sf_dir):
    """The target list, and files of broken lines beside it: the good rows' tickers, and each
    rejected line with reason and folder."""
    from ..sources.files import scan_targets
    path = _store_dir(spark, "targets_mixed")
    k = F.col("c_custkey").cast("string")
    c = read_table(spark, sf_dir, "customer")
    c.select(F.concat(F.lit("T, "), k).alias("ticker"), F.col("c_custkey").alias("price"), F.lit(1.5).alias("target_price")).write.option("header", True).csv(f"{path}/good")
    m = F.col("c_custkey") % 4
    line = (F.when(m == 0, F.concat(F.lit("T"), k, F.lit(",1.0"))).when(m == 1, F.concat(F.lit("T"), k, F.lit(",1.0,2.0,3.0")))
            .when(m == 2, F.concat(F.lit(","), k, F.lit(",2.0"))).otherwise(F.concat(F.lit("T"), k, F.lit(",one,2.0"))))
    c.select(line.alias("value")).write.text(f"{path}/broken")
    good, bad = scan_targets(spark, path)
    held = good.select(F.concat("ticker", F.lit(" "), F.col("price").cast("bigint").cast("string")).alias("line"), F.lit("good").alias("reason"), F.lit("good").alias("folder"))
    return held.unionByName(_folder(bad))


# --- streaming, enrichment hook, request tables (T1, U1, P21) ---------------
from ..operators import enrich as EN  # noqa: E402


@register("incremental_headlines")
def q_incremental_headlines(spark, sf_dir):
    """Events arrive as several files; the incremental job links and stores
    them; a second run over the same source adds nothing."""
    from ..session import scratch_path
    from ..streaming.incremental import SINK_COLUMNS, incremental
    ev = read_table(spark, sf_dir, "events")
    src = scratch_path(spark, "events_src")
    ev.repartition(6, F.to_date("ts")).write.parquet(src)
    sink = scratch_path(spark, "stream_sink")
    master = A.master(spark, sf_dir)
    for _ in range(2):  # a new checkpoint sees every file again: the store's anti-join drops all rows
        incremental(spark, src, ev.schema, master, sink, scratch_path(spark, "stream_ckpt"), A.headlines_from_events)
    from ..streaming.incremental import SINK_SCHEMA
    return ST.read_store(spark, sink, schema=SINK_SCHEMA).select(*SINK_COLUMNS)


def _ascii_upper(text: str) -> str:
    """Stand-in for an external call: fails on any non-ASCII text."""
    return text.encode("ascii").decode("ascii").upper()


@register("batch_enrich")
def q_batch_enrich(spark, sf_dir):
    h = A.headlines(spark, sf_dir).select("seq", "title")
    return EN.batch_enrich(h, _ascii_upper, "title", "translated", fallback_col="title").select(
        "seq", "translated")


@register("cached_enrich")
def q_cached_enrich(spark, sf_dir):
    """U1 with a reply cache: two runs over the same headlines; the second asks nothing that has a reply."""
    from ..operators.replies import enrich_cached
    h = A.headlines(spark, sf_dir).select("seq", "title")
    root = _store_dir(spark, "replies")
    for _ in range(2):
        out = enrich_cached(h, _ascii_upper, "title", "translated", root, fallback_col="title")
    return out.select("seq", "translated")


@register("build_prompts")
def q_build_prompts(spark, sf_dir):
    """Request texts - the polarity question per headline, a summary request
    per page (name = h1, overview = first li, status = first ad block)."""
    h = A.headlines(spark, sf_dir).select(F.lit("headline").alias("src"), F.col("seq").alias("id"),
                                          EN.ko_question(T.strip_hyphen("title")).alias("prompt"))
    p = _pages(spark, sf_dir)
    pr = p.select(F.lit("page").alias("src"), F.col("page_id").alias("id"),
                  EN.summary_request(H.first_text(F.col("html"), "h1"), H.first_text(F.col("html"), "li"),
                                     H.first_text(F.col("html"), "div", "ad")).alias("prompt"))
    return h.unionByName(pr)


@register("build_text_prompts")
def q_build_text_prompts(spark, sf_dir):
    """The plain and the report summary request of each document, the completion request of
    each headline."""
    d = _docs(spark, sf_dir).where(F.col("text").isNotNull())
    asked = [d.select(F.lit(kind).alias("src"), F.col("doc_id").alias("id"), build(F.col("text")).alias("prompt"))
             for kind, build in (("text", EN.text_summary_request), ("report", EN.report_summary_request))]
    h = A.headlines(spark, sf_dir).select(F.lit("headline").alias("src"), F.col("seq").alias("id"), EN.completion_request(F.col("title")).alias("prompt"))
    return asked[0].unionByName(asked[1]).unionByName(h)


@register("lexicon_sentiment_modified")
def q_lexicon_sentiment_modified(spark, sf_dir):
    """A7 with the modifier layer (rows-only here; the rule is checked by fixtures)."""
    lex = SE.lexicon_from_corpus(_corpus_tokens(spark, sf_dir))
    conv = read_table(spark, sf_dir, "conversations")
    return SE.lexicon_sentiment_modified(conv, ["conv_id", "turn"], "text", lex)


@register("job_ko_stored")
def q_job_ko_stored(spark, sf_dir):
    """Q1 end to end: fact and details appended, error reports purged; the stored
    fact after the run."""
    fact = _job_ko(spark, sf_dir, True)
    froot, droot = _store_dir(spark, "run_fact"), _store_dir(spark, "run_detail")
    J.run_ko_job(fact, filed_pages(spark, sf_dir), rate_cells(spark, sf_dir), froot, droot)
    return ST.read_store(spark, froot, schema=fact.schema).select(*J.FACT_COLUMNS)


@register("format_floats")
def q_format_floats(spark, sf_dir):
    """P17 floats: thousands separators with the shortest round-trip digits."""
    li = read_table(spark, sf_dir, "lineitem")
    v = F.col("l_extendedprice") * (1 + F.col("l_tax")) * 1000
    return li.select("l_extendedprice", "l_tax", T.fmt_float(v).alias("value_text"),
                     T.fmt_float(-F.col("l_discount")).alias("discount_text"))


@register("format_floats_wide")
def q_format_floats_wide(spark, sf_dir):
    """P17 floats of every size, subnormal ones and such beyond 1e300 included."""
    li = read_table(spark, sf_dir, "lineitem")
    number = F.concat(F.col("l_partkey").cast("string"), F.lit("."), F.col("l_suppkey").cast("string"), F.lit("7e"),
                      (F.col("l_orderkey") % 620 - 320).cast("string"))
    return li.select("l_orderkey", "l_linenumber", T.fmt_float(number.cast("double")).alias("value_text"))

"""Whole jobs composed from the operators (Q1 KO job, Q2 US job, Q3 light KO
job, Q4 filing digest requests).

Each job is one DataFrame plan: Catalyst sees every join and aggregate at once,
so filters and projections reach the scans, AQE sees the size of the small dimensions
(master, dictionaries, per-code detail), and the big inputs (headlines, quotes, store)
are read once.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.language import verdict
from ..functions.text import keep_alnum_hangul, normalise_ws, py_strip, section_after, truncate_words
from ..operators import features as FE
from ..operators import linking, models, pages, quotes, sentiment, store, valuation
from ..operators.enrich import asked_summary, company_summary, us_request
from ..operators.usjob import extract_ticker
from ..session import few_keys, materialize, stored

# The columns of the three result tables.
FACT_COLUMNS = ["key_", "date_", "time_", "code_", "name_", "content_", "pn_", "ratio_",
                "close_", "diff_", "open_", "high_", "low_", "volume_", "gpt_pn_", "report_"]
DETAIL_COLUMNS = ["key_", "date_", "code_", "ticker_desc1", "ticker_desc2", "sise_52_price",
                  "sise_revenue_rate", "sise_siga_tot", "sise_siga_tot2", "sise_issue_stock_normal",
                  "toja_discision", "toja_prop_price", "toja_eps", "toja_per", "toja_comp",
                  "srim_revenue_rate", "srim_jibea", "srim_roa", "srim_roe", "srim_value",
                  "srim_issue_stock", "srim_prop_price", "srim_10_price", "srim_20_price"]
US_COLUMNS = ["ticker", "date_", "time_", "headline", "company_name", "report_",
              "neg", "neu", "pos", "compound"]


@dataclass
class BowModel:
    vocab: DataFrame
    weights: DataFrame


def bow_model(corpus: DataFrame, root: str | None = None) -> BowModel:
    """Vocabulary (top 5000) and per-term weights from the labelled corpus; both are stored once
    for the consumers in the run. With ``root`` a run loads the model that an earlier one stored
    there for the same corpus."""
    vocab, weights = _fit(corpus) if root is None else models.model_for(corpus, root, _fit, ["id", "document", "label"])
    return BowModel(F.broadcast(vocab), F.broadcast(weights))  # at most 5000 rows each


def _fit(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    c = stored(corpus.select("id", "label", FE.tokenise("document").alias("tokens")), "bow-tokens")  # tokenised once
    vocab = stored(FE.vocabulary(c), "bow-vocab")
    weights = stored(sentiment.corpus_weights(c, vocab), "bow-weights")
    return vocab, weights


def _run_time(run_time: str):
    hh, mm = run_time.split(":")
    return hh + mm, run_time


def _select_headlines(headlines: DataFrame) -> DataFrame:
    """W3 per run: drop page lists equal to one seen earlier in the run. A run that looked back
    (``list_date``) sees the newest day first."""
    day = ["list_date"] if "list_date" in headlines.columns else []
    order = [F.datediff(F.lit("9999-12-31"), c) for c in day] + [F.col("page_no"), F.col("slot")]
    kept, _ = pages.dedupe_pages(headlines, ["run_date", *day, "page_no", "slot"], order, run_cols=["run_date"])
    return kept


def look_back_headlines(spark: SparkSession, root: str, schema, run_day: str | None = None, min_lists: int = 10) -> DataFrame:
    """The headlines of one run (of ``run_day``, the newest stored unless given) from a store
    partitioned by ``run_date`` (yyyy-MM-dd): those of its day and, while fewer than
    ``min_lists`` distinct page lists are held, of the days before. All count as the run's;
    ``list_date`` is the day they come from."""
    now = store.snapshot(spark, root)
    days = [d for d in reversed(store.partition_values(now, "run_date")) if run_day is None or d <= run_day]
    run_day = run_day or (days[0] if days else None)

    def read(some: list[str]) -> DataFrame:
        rows = store.read_store(spark, root, schema=schema, partitions={"run_date": some}, version=now)
        return rows.withColumn("run_date", F.to_date("run_date"))
    items, _ = pages.look_back(days, read, ["run_date", "page_no", "slot"], min_lists)
    return items.withColumn("list_date", F.col("run_date")).withColumn("run_date", F.to_date(F.lit(run_day)))


def _link(headlines, master, legacy_carry):
    if legacy_carry:
        return linking.link_with_legacy_carry(headlines, master)
    return linking.link_headlines(headlines, master)


def job_ko(headlines: DataFrame, master: DataFrame, fact_store: DataFrame, quote_rows: DataFrame,
           model: BowModel | None, negative_words: DataFrame | None, run_time: str = "18:00",
           replies: DataFrame | None = None, legacy_carry: bool = False,
           quote_tiebreak: list[str] | None = None) -> DataFrame:
    """Q1 (``model`` given) / Q3 (``model`` None: no NLP, pn = gpt_pn = '', ratio 0).

    Every run date in ``headlines`` is one run. Output: the 16-column fact."""
    hhmm, hh_mm = _run_time(run_time)
    h = _select_headlines(headlines)
    linked = _link(h, master, legacy_carry).withColumn("date_", F.date_format("run_date", "yyyy-MM-dd"))
    fresh = linking.new_only(linked, fact_store, [("code", "code_"), ("date_", "date_")])
    # scoring, quotes and reports all fan out from the new articles: compute once
    fresh = materialize(fresh)
    codes = few_keys(fresh.select("code").where("code IS NOT NULL"), "fresh-codes")
    if model is not None:
        if replies is not None:
            fresh = fresh.join(replies.select("seq", "reply"), "seq", "left")
            gpt = verdict(F.coalesce(F.col("reply"), F.col("content")), "P")
        else:
            gpt = verdict(F.col("content"), "P")
        fresh = fresh.withColumn("gpt_pn_", gpt).withColumn("tokens", FE.tokenise("content"))
        scored = sentiment.bow_score(fresh.select(F.col("seq").alias("id")),
                                     FE.term_occurrences(fresh.select(F.col("seq").alias("id"), "tokens")),
                                     model.weights)
        fresh = fresh.join(scored.withColumnRenamed("id", "seq"), "seq")
        fresh = sentiment.keyword_override(fresh, "pn", "content", negative_words, "nag_word", "pn_")
        fresh = fresh.withColumn("ratio_", F.col("ratio"))
    else:
        fresh = (fresh.withColumn("pn_", F.lit("")).withColumn("gpt_pn_", F.lit(""))
                 .withColumn("ratio_", F.lit(0.0)))
    if codes is not None:  # other companies' quotes are not sorted
        quote_rows = quote_rows.join(codes, "code", "left_semi")
    latest = quotes.latest_quote(quote_rows, tiebreak=quote_tiebreak)
    fresh = quotes.attach_quote(fresh, latest)
    fresh = store.reuse_reports(fresh, fact_store)
    return fresh.select(
        F.concat(F.date_format("run_date", "yyyyMMdd"), F.lit(hhmm), F.col("code")).alias("key_"),
        "date_", F.lit(hh_mm).alias("time_"), F.col("code").alias("code_"), F.col("name").alias("name_"),
        F.col("content").alias("content_"), "pn_", F.col("ratio_").cast("double").alias("ratio_"),
        *[F.col(c).alias(c + "_") for c in quotes.QUOTE_VALUES], "gpt_pn_",
        F.col("report").alias("report_"))


def details(fact: DataFrame, company_pages: DataFrame, rate_cells: DataFrame,
            materialized: bool = False) -> DataFrame:
    """Detail rows (24 columns, all strings) for every fact row: market snapshot,
    consensus and S-RIM per code, computed once per distinct code and joined
    back (the per-code side is bounded by the master; AQE sees its size)."""
    if not materialized:
        fact = materialize(fact)  # read twice below (codes, and the join back)
    codes = fact.select(F.col("code_").alias("code")).where("code IS NOT NULL")
    few = few_keys(codes, "fact-codes")  # then no page is shuffled, nor made, for a company without articles
    pg = company_pages.join(codes.distinct() if few is None else few, "code", "left_semi")
    pg = valuation.with_tables(pg)
    pg = pg.select("code", "tables", *valuation.company_profile(F.col("html")))
    pg = valuation.market_snapshot(pg)
    pg = valuation.consensus(pg)
    k, shown = valuation.required_return(rate_cells)
    per_code = valuation.srim(pg, k, shown)
    out = fact.select(F.concat(F.substring("key_", 1, 8), F.col("code_")).alias("key_"),
                      F.substring("key_", 1, 8).alias("date_"), "code_")
    out = out.join(per_code, out["code_"] == per_code["code"], "left").drop("code")
    # an article without a page keeps the defaults, and the rate, which comes from elsewhere
    rate = F.coalesce("srim_revenue_rate", shown)
    out = out.withColumn("srim_revenue_rate", rate).fillna(valuation.MISSING, subset=DETAIL_COLUMNS[3:])
    return store.render_details(out.select(*DETAIL_COLUMNS))


def us_articles_named(articles: DataFrame, us_store: DataFrame, company_pages: DataFrame) -> DataFrame:
    """New US headlines with ticker (P4, J4), company name from the ticker's page (V5; a
    headline whose page is missing is skipped) and the stored report, if any (J5)."""
    a = extract_ticker(articles, "headline").withColumn("date_", F.date_format("run_date", "yyyyMMdd"))
    a = linking.new_only(a, us_store, [("ticker", "ticker"), ("date_", "date_")])
    names = company_pages.select("ticker", *valuation.company_profile(
        F.col("html"), ("span", "symbol-page-header__name"), ("span", "symbol-page-header__name"),
        ("company_name", "_unused"))).withColumn("company_name", py_strip("company_name")).where(
        F.col("company_name") != valuation.MISSING)
    names = names.groupBy("ticker").agg(F.min("company_name").alias("company_name"))
    return store.reuse_reports(a.join(names, "ticker"), us_store, "ticker", "ticker", "report_")


def job_us(articles: DataFrame, us_store: DataFrame, company_pages: DataFrame,
           lexicon: DataFrame, run_time: str = "18:00") -> DataFrame:
    """Q2: the new US headlines, named, with stored reports and the full lexicon score (A7
    with its modifier layer)."""
    hhmm, _ = _run_time(run_time)
    a = us_articles_named(articles, us_store, company_pages)
    scores = sentiment.lexicon_sentiment_modified(a, ["seq"], "headline", lexicon)
    a = a.join(scores, "seq")
    # the US fact keeps the run date and time as YYYYMMDD / HHMM
    return a.select("ticker", "date_", F.lit(hhmm).alias("time_"), "headline", "company_name",
                    F.col("report").alias("report_"), "neg", "neu", "pos", "compound")


def report_requests(articles: DataFrame, us_store: DataFrame, company_pages: DataFrame) -> DataFrame:
    """The prompts of the US headlines without a reusable report: what a model client answers."""
    a = us_articles_named(articles, us_store, company_pages).where("needs_report")
    return a.select("seq", "ticker", us_request(F.col("company_name"), F.col("headline")).alias("prompt"))


def report_requests_ko(fact: DataFrame, company_pages: DataFrame) -> DataFrame:
    """The prompts of the companies in a KO fact without a reusable report: what a model client
    answers. A company without a page, or whose page has no summary block, gets none."""
    wanted = fact.where(F.col("report_") == "").select(F.col("code_").alias("code"), F.col("name_").alias("name")).distinct()
    # only the summary block of a page takes part, and it is merged: the size of pages made or
    # read from a compact file is underestimated, and all of them would be broadcast. Exploded,
    # so that the test for a block is not pushed down to the few tasks that read the file
    block = F.explode_outer(F.array(company_summary(F.col("html"))))
    summaries = company_pages.select("code", block.alias("summary")).where("summary IS NOT NULL")
    asked = wanted.join(summaries.hint("merge"), "code")
    return asked.select("code", "name", asked_summary(F.col("name"), F.col("summary")).alias("prompt"))


def run_us_job(fact: DataFrame, root: str) -> store.Snapshot:
    """The US run's sink: the rows without an error report are appended, which leaves what
    "append, then delete error reports" would."""
    keep = ~F.coalesce(F.col("report_").rlike(store.ERROR_PATTERN), F.lit(False))
    return store.append(fact.where(keep), root, sort_by=["date_", "ticker"])


# Fixed value: the filing report type, and the prompt that asks for a summary.
FILING_TYPE = "10-K"
FILING_PROMPT = ("The following text is part of the {company} report. Please summarize the main "
                 "business aspects of this company using bullet points in 3 to 4 sentences or less:\n\n")
FILING_WORDS = 1024


def filing_requests(docs: DataFrame, company_col: str, text_col: str, delimiter: str = "FORM 10-K",
                    n_words: int = FILING_WORDS) -> DataFrame:
    """Q4: filing text -> normalised whitespace -> section after the delimiter ->
    letters/digits/Hangul only -> first ``n_words`` words -> prompt text. A
    filing without the delimiter gets no prompt (``prompt`` null, the error path)."""
    # staged: each intermediate text is computed once and read by name
    staged = (docs.withColumn("_sec", section_after(normalise_ws(F.col(text_col)), delimiter))
              .withColumn("_kept", keep_alnum_hangul(F.col("_sec"))))
    head = F.format_string(FILING_PROMPT.replace("{company}", "%s"), F.col(company_col))
    body = truncate_words(F.col("_kept"), n_words)
    return (staged.withColumn("prompt", F.when(F.col("_sec").isNotNull(), F.concat(head, body)))
            .drop("_sec", "_kept"))


def run_ko_job(fact: DataFrame, company_pages: DataFrame, rate_cells: DataFrame,
               fact_root: str, detail_root: str, purge_existing: bool = False) -> tuple[store.Snapshot, store.Snapshot]:
    """The whole KO run: append the fact (K1, partitioned by date_) without rows
    whose report matches the error pattern, then append the detail rows for
    every article (K2; details are never purged).

    Every fact row enters through this run, so filtering the run's own rows
    leaves the store exactly as "append, then delete matching rows" would - and
    it never rewrites earlier partitions. ``purge_existing`` additionally runs
    the purge (K4) for rows written by other means. Each append commits on its own, so a failed detail step leaves the
    fact stored. Returns (fact version, detail version)."""
    spark = fact.sparkSession
    fact = materialize(fact)  # written, and read again for the details
    keep = ~F.coalesce(F.col("report_").rlike(store.ERROR_PATTERN), F.lit(False))
    stored_fact = store.append(fact.where(keep), fact_root, partition_by=["date_"])
    stored_details = store.append(details(fact, company_pages, rate_cells, materialized=True), detail_root)
    if purge_existing:
        stored_fact = store.purge(spark, fact_root, fact.schema, ["date_"])
    return stored_fact, stored_details

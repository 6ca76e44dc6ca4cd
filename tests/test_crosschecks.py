"""Cross-checks between operators: J1 within J2, W1 vs a window."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerlens.functions.text import headline_key
from tickerlens.operators import linking
from tickerlens.operators import quotes as Q
from tickerlens.plans import adapters as A

SF = "/root/testdata/sf0.001"


def test_exact_links_are_candidates(spark):
    h = A.headlines(spark, SF)
    m = A.master(spark, SF)
    linked = linking.link_headlines(h, m)
    cand = linking.candidate_counts(h.withColumn("key", headline_key("title")), m)
    j = linked.join(cand, "key", "left")
    assert j.where(F.coalesce("n_candidates", F.lit(0)) < 1).count() == 0
    assert j.where(~F.col("name").contains(F.col("key"))).count() == 0
    assert linked.count() > 0


def test_latest_quote_equals_row_number(spark):
    q = A.quotes(spark, SF)
    got = Q.latest_quote(q, tiebreak=A.QUOTE_TIEBREAK)
    order = [F.col("date").desc()] + [F.col(c).desc() for c in A.QUOTE_TIEBREAK + Q.QUOTE_VALUES]
    w = Window.partitionBy("code").orderBy(*order)
    whole = q.dropna(subset=["date", *Q.QUOTE_VALUES])  # incomplete quotes are dropped first
    ref = (whole.withColumn("rn", F.row_number().over(w))
           .where("rn = 1").select("code", "date", *Q.QUOTE_VALUES))
    cols = ["code", "date"] + Q.QUOTE_VALUES
    assert got.select(*cols).exceptAll(ref.select(*cols)).count() == 0
    assert ref.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_run_ko_job_store_equals_append_then_purge(spark):
    from tickerlens.operators import store as ST
    from tickerlens.plans import jobs as J
    from tickerlens.plans.queries import _job_ko, company_pages, rate_cells
    from tickerlens.session import scratch_path
    fact = _job_ko(spark, SF, False)
    a, b = scratch_path(spark, "fa"), scratch_path(spark, "fb")
    J.run_ko_job(fact, company_pages(spark, SF), rate_cells(spark, SF), a, scratch_path(spark, "da"))
    J.run_ko_job(fact, company_pages(spark, SF), rate_cells(spark, SF), b, scratch_path(spark, "db"),
                 purge_existing=True)
    ra = ST.read_store(spark, a, schema=fact.schema)
    rb = ST.read_store(spark, b, schema=fact.schema)
    assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_job_ko_legacy_carry_adds_carried_rows(spark):
    from tickerlens.plans import jobs as J
    h, m, st, q = A.headlines(spark, SF), A.master(spark, SF), A.store(spark, SF), A.quotes(spark, SF)
    plain = J.job_ko(h, m, st, q, None, None, quote_tiebreak=A.QUOTE_TIEBREAK)
    legacy = J.job_ko(h, m, st, q, None, None, quote_tiebreak=A.QUOTE_TIEBREAK, legacy_carry=True)
    assert plain.exceptAll(legacy).count() == 0
    assert legacy.count() > plain.count()

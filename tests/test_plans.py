"""Plan-shape checks: the physical strategies the design relies on."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()  # run, so AQE's final plan exists
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def test_link_is_broadcast_hash_join(spark):
    plan = final_plan(E.queries()["linked_quotes"](spark, SF))
    assert "BroadcastHashJoin" in plan


def test_new_only_is_anti_join(spark):
    plan = final_plan(E.queries()["new_only"](spark, SF))
    assert "LeftAnti" in plan


def test_light_job_has_no_python(spark):
    plan = final_plan(E.queries()["job_ko_light"](spark, SF))
    assert "EvalPython" not in plan and "MapInPandas" not in plan


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["table_scan"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date_" in plan
    assert "ReadSchema: struct<seq:bigint,code_:string,report_:string>" in plan


def test_latest_quote_is_partial_aggregate(spark):
    plan = final_plan(E.queries()["linked_quotes"](spark, SF))
    assert "partial_max_by" in plan


def test_pages_are_dealt_out_before_they_are_rendered(spark):
    """One small file of parts is not one task that reads all of their pages."""
    from tickerlens.plans import queries as Q
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for pages in (Q.company_pages(spark, SF), Q.listing_pages(spark, SF)):
        per_task = pages.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert len(per_task) == n and max(per_task) < 2 * sum(per_task) / n


def test_company_pages_are_never_broadcast_for_requests(spark):
    """Their size is estimated from a compact file; the prompts come from a merge of the summary blocks."""
    from pyspark.sql import functions as F
    from tickerlens.plans import jobs as J
    fact = spark.createDataFrame([("000001", "A", ""), ("000002", "B", ""), ("000003", "C", "kept")], "code_ string, name_ string, report_ string")
    pages = spark.range(1, 4).select(F.format_string("%06d", "id").alias("code"), F.when(F.col("id") != 2, F.lit(
        '<div class="um_bssummary"><h3>s</h3><li>o</li></div>')).otherwise(F.lit("<p>")).alias("html"))
    got = J.report_requests_ko(fact, pages)
    assert [(r.code, "<li>o</li>" in r.prompt) for r in got.collect()] == [("000001", True)]
    assert "Broadcast" not in final_plan(got)


def test_a_task_renders_so_many_pages_at_most(spark, monkeypatch):
    """With more parts there are more tasks, not larger ones."""
    from tickerlens import session
    from tickerlens.plans import queries as Q
    monkeypatch.setattr(session, "ROWS_A_TASK", 5)
    n = session.read_table(spark, SF, "part").count()
    assert n > 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for pages in (Q.company_pages(spark, SF), Q.listing_pages(spark, SF)):
        per_task = pages.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert len(per_task) == -(-n // 5) and sum(per_task) == n and max(per_task) < 20

"""The table reader: numbering, nesting, spans, headers, malformed markup."""
import time

import pytest
from pyspark.sql import functions as F

from tickerlens.sources import html as H


def tables(spark, html, **kw):
    """{table number: (header, {row: [cells]})}"""
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    out = {}
    for r in H.html_tables(df, **kw).orderBy("table_no", "row_no", "col_no").collect():
        head, rows = out.setdefault(r.table_no, ({}, {}))
        rows.setdefault(r.row_no, []).append(r.cell)
        head[r.col_no] = r.header
    return {n: ([h[c] for c in sorted(h)], [rows[k] for k in sorted(rows)]) for n, (h, rows) in out.items()}


def test_nested_tables_keep_numbers_and_rows(spark):
    page = ("x<TABLE><tr><td>a</td><td>b<table><tr><td>in <b>1</b></td></tr><tr><td>in 2<table><tr><td>deep</td></tr></table></td></tr></table>c</td></tr>"
            "<tr><td>d</td><td>e</td></tr></TABLE><table><tr><td>last</td></tr></table>")
    got = tables(spark, page)
    assert [got[n][1] for n in range(4)] == [[["a", "bin 1in 2deepc"], ["d", "e"]], [["in 1"], ["in 2deep"]], [["deep"]], [["last"]]]


@pytest.mark.parametrize("page,want", [
    ("<table><tr><td>a<td> b &amp; c <tr><td>d</table>", [[["a", "b & c"], ["d"]]]),  # no end tags
    ("</table><table><tr><td>a</td></tr>", [[["a"]]]),  # stray end tag, open end
    ("<table><tr><td>a<table><tr><td>b</td></tr>", [[["a"]], [["b"]]]),  # both left open
    ("<p>no table</p>", []), ("", []), ("<table></table>", []),
    ("<table><tr><td>a</td></tr></table> <td>stray</td> <table><tr><td></td></tr></table>", [[["a"]], [[""]]]),
    ("<table><tr><td rowspan='2'>r</td><td colspan=2>c</td></tr><tr><td>x</td><td>y</td></tr></table>", [[["r", "c", "c"], ["r", "x", "y"]]]),
    ("<table><tr><td ROWSPAN=3>r</td><td>1</td></tr><tr></tr><tr><td>2</td><td colspan=\"2\">3</td></tr></table>", [[["r", "1"], ["r"], ["r", "2", "3", "3"]]]),
])
def test_markup_as_found(spark, page, want):
    got = tables(spark, page)
    assert [got[n][1] for n in sorted(got)] == want


def test_headers(spark):
    page = ("<table><thead><tr><th>x</th></tr><tr><th>a<br></th></tr></thead><tbody><tr><th>l</th></tr></tbody></table>"
            "<table><tr><th>a</th><th>b</th></tr><tr><th>c</th><th>d</th></tr><tr><th>l</th><td>1</td></tr></table>"
            "<table><tr><th>l</th><td>1</td></tr></table>")
    got = tables(spark, page)
    assert got[1] == (["c", "d"], [["l", "1"]]) and got[2] == ([None, None], [["l", "1"]])
    view = spark.createDataFrame([(page,)], "h string").select(H.table_view(F.get(H.table_markups(F.col("h")), 1)).alias("v"))
    assert tuple(view.select(H.cell_at(F.col("v"), 0, "d"), H.cell_at(F.col("v"), 0, "z"), H.cell_at(F.col("v"), 0, 0), H.cell_at(F.col("v"), 4, 0)).first()) == ("1", None, "l", None)


def test_links_and_class(spark):
    page = "<table class='no'><tr><td>z</td></tr></table><table class=\"wide list\"><tr><td><a class=x href='/a?b&amp;c'>A</a></td><td>-</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    got = H.html_tables(df, css_class="list", links=True).orderBy("col_no").collect()
    assert [(r.table_no, r.cell, r.link) for r in got] == [(0, "A", "/a?b&amp;c"), (0, "-", None)]


def test_time_per_page_is_bounded(spark):
    """A page of 400 cells in 8 tables: a few cells of one table cost far less than reading all cells did."""
    page = ("<table><tr><th>a</th><th>b</th></tr>" + "<tr><th>l</th><td>1,234</td></tr>" * 24 + "</table>") * 8
    df = spark.range(0, 4000, 1, 4).select(F.concat(F.lit(page), F.col("id").cast("string")).alias("h")).select(H.table_markups(F.col("h")).alias("t"))
    q = df.select(H.table_view(F.get("t", F.lit(3))).alias("v")).select(*[H.cell_at(F.col("v"), i, 1).alias(f"c{i}") for i in range(5)])
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        q.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    assert min(times) < 6, times  # 1.5 ms a page on one of four cores; some 25 ms a page when spans were looked for in every cell


def test_long_form_reads_each_page_table_and_row_once(spark):
    """The optimizer adds no filter that reads the markup again before it is exploded."""
    cells = H.html_tables(spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>")], "page_id long, html string"))
    plan = cells.where("table_no = 0 AND row_no IN (0, 1)")._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in "".join(line for line in plan.splitlines() if "Filter" in line), plan
    assert plan.count(H._TABLE_TAG) == 1

import pytest
from pyspark.sql import functions as F

from tickerlens.operators import valuation as V

HDR10 = ["IFRS", "2019", "2020", "2021", "2022", "2023E", "2024E", "2025E", "2026E"]


def _table(header, rows):
    th = "".join(f"<th>{h}</th>" for h in header)
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<table><tr>{th}</tr>{body}</table>"


def page(e, roa, roe, shares_text="10,000,000/ 5", treasury="", snap3="123", target="5000"):
    t0 = _table(["항목", "값"], [["a", "1"], ["52주", "10/5"], ["수익률", "3"], ["시총", snap3],
                                 ["시총2", "77"], ["x", "1"], ["주식수", shares_text]])
    t4 = _table(["구분", "보통주", "우선주"], [["r", "0", "0"]] * 4 + [["자기", treasury, "0"]])
    t7 = _table(["의견", "목표", "EPS", "PER", "수"], [["매수", target, "1200", "9.5", "7"]])
    rows10 = [[f"r{i}"] + [""] * 8 for i in range(18)]
    rows10[9] = ["지배"] + [str(x) for x in e]
    rows10[16] = ["ROA"] + [str(x) for x in roa]
    rows10[17] = ["ROE"] + [str(x) for x in roe]
    ph = "<table><tr><td>-</td></tr></table>"
    return "<html>" + t0 + ph * 3 + t4 + ph * 2 + t7 + ph * 2 + _table(HDR10, rows10) + "</html>"


def run_srim(spark, html, k=8.0, shown="8.0"):
    df = spark.createDataFrame([("c", html)], "code string, html string")
    df = V.market_snapshot(V.with_tables(df), keep=["code", "tables"])
    return V.srim(df, F.lit(k), F.lit(shown), keep=["code"]).collect()[0]


@pytest.mark.parametrize("roa,roe,fair,p9,p8", [
    (10, 12, "15,000", "12,000", "11,142"),
    (3, 4, "5,000", "2,000", "1,142"),
    (10, 20, "25,000", "11,000", "10,571"),
    (10, 15, "18,750", "13,500", "12,000"),
])
def test_srim_hand_cases(spark, roa, roe, fair, p9, p8):
    e = [900, 950, 1000, "", "", "", "", "NaN"]
    r = run_srim(spark, page(e, [1, 2, 3, roa, 99, 99, 99, 99], [1, 2, 3, roe, 99, 99, 99, 99]))
    assert (r.srim_prop_price, r.srim_10_price, r.srim_20_price) == (fair, p9, p8)
    assert r.srim_jibea == "1,000.0" and r.srim_issue_stock == "10,000,000"


def test_srim_zero_shares_aborts_prices(spark):
    r = run_srim(spark, page([1000], [10], [12], treasury="10000000"))
    assert r.srim_issue_stock == "0" and (r.srim_prop_price, r.srim_10_price, r.srim_20_price) == ("-", "-", "-")


def test_srim_zero_rate_aborts_from_value(spark):
    r = run_srim(spark, page([1000], [10], [12]), k=0.0, shown="0.0")
    assert r.srim_roe == "12.0" and r.srim_value == "-" and r.srim_20_price == "-"


def test_sequential_defaults_third_of_five(spark):
    df = spark.createDataFrame([("c", page([1], [1], [1], snap3="N/A"))], "code string, html string")
    r = V.market_snapshot(V.with_tables(df), keep=["code"]).collect()[0]
    assert (r.sise_52_price, r.sise_revenue_rate) == ("10/5", "3")
    assert (r.sise_siga_tot, r.sise_siga_tot2, r.sise_issue_stock_normal) == ("-", "-", "-")


def test_consensus_and_missing_table(spark):
    df = spark.createDataFrame([("a", page([1], [1], [1])), ("b", "<html>no tables</html>")],
                               "code string, html string")
    got = {r.code: r for r in V.consensus(V.with_tables(df), keep=["code"]).collect()}
    assert (got["a"].toja_prop_price, got["a"].toja_eps, got["a"].toja_comp) == ("5,000", "1,200", "7")
    assert got["b"].toja_discision == "-" and got["b"].toja_comp == "-"


def test_required_return_default(spark):
    cells = spark.createDataFrame([(0, 0, 3, 3, "5년", "9.25")],
                                  "page_id long, table_no int, row_no long, col_no int, header string, cell string")
    k, shown = V.required_return(cells)
    r = spark.range(1).select(k.alias("k"), shown.alias("s")).collect()[0]
    assert (r.k, r.s) == (20.0, "-")
    cells2 = spark.createDataFrame([(0, 0, 10, 3, "5년", "9.25")], cells.schema)
    k, shown = V.required_return(cells2)
    r = spark.range(1).select(k.alias("k"), shown.alias("s")).collect()[0]
    assert (r.k, r.s) == (9.25, "9.25")

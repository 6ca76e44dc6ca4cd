"""Company detail and S-RIM valuation (V1-V5, J9, W5, A6 in-row).

All fields come from one page row (``page_tables``) - no shuffle. Each block
follows the job's sequential rule (W5): fields are filled in order and the
first one that cannot be produced leaves itself and every later field of the
block at '-'.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fmt_float, fmt_int, let, parse_shares
from ..sources.html import cell_at, first_text, row_at, table_markups, table_view
from .quotes import last_valid_in

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference job's behaviour)
# ---------------------------------------------------------------------------
DEFAULT_REQUIRED_RETURN = 20.0     # percent, when the rate table is unavailable
RATE_ROW, RATE_COLUMN = 10, "5년"  # BBB- 5-year yield cell
ROE_ROA_SWITCH = 5.0               # ROE - ROA above this -> value with ROA
DECAY_WEIGHTS = (0.9, 0.8)         # excess-return persistence scenarios
UNIT = 100000000.0                 # equity is stated in units of 1e8
MISSING = "-"
TREASURY_COLUMN = "보통주"
# ---------------------------------------------------------------------------


def sequential(df: DataFrame, fields: list[tuple[str, Column]], keep: list[str] | None = None) -> DataFrame:
    """``fields`` = [(name, value-or-null)] in fill order; field i keeps its
    value only if fields 1..i all succeeded, else '-'. Values are projected once,
    the running success test is a second, cheap projection over them."""
    keep = keep if keep is not None else df.columns
    staged = df.select(*keep, *[v.alias(f"_w{i}") for i, (_, v) in enumerate(fields)])
    out, ok = [], F.lit(True)
    for i, (name, _) in enumerate(fields):
        ok = ok & F.col(f"_w{i}").isNotNull()
        out.append(F.when(ok, F.col(f"_w{i}")).otherwise(F.lit(MISSING)).alias(name))
    return staged.select(*keep, *out)


def _plain(c: Column) -> Column:
    """A cell as a table reader sees it: thousands commas go when the whole cell is a number."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[-+]?[0-9][0-9,]*(\.[0-9]*)?$"), F.replace(t, F.lit(","), F.lit(""))).otherwise(t)


def _int_text(c: Column) -> Column:
    """``int(cell)``: null when the cell is no number, or beyond the range of a long."""
    return _plain(c).try_cast("decimal(38,6)").try_cast("bigint")


def _int_cell(view: Column, row: int, col: int) -> Column:
    """A cell as an integer with thousands commas."""
    return let(cell_at(view, row, col), lambda c: fmt_int(_int_text(c)))


def _num(c: Column) -> Column:
    """Cell -> double; '' and unparsable -> null ('NaN' stays NaN)."""
    return _plain(c).try_cast("double")


def with_tables(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``tables``, the markup of each table of the page; what is read of them is cut from it."""
    return pages.withColumn("tables", table_markups(F.col(html_col)))


def _viewed(df: DataFrame, tables: str, numbers: tuple[int, ...]) -> DataFrame:
    """Adds a view ``_t<n>`` of each of these tables, read once for all of its cells."""
    return df.select("*", *[table_view(F.get(F.col(tables), n)).alias(f"_t{n}") for n in numbers])


def market_snapshot(df: DataFrame, tables: str = "tables", keep: list[str] | None = None) -> DataFrame:
    """V2: table 0, column 1 of rows 1, 2, 3, 4, 6 (3 and 4 as integers with commas)."""
    t = F.col("_t0")
    return sequential(_viewed(df, tables, (0,)), [
        ("sise_52_price", cell_at(t, 1, 1)),
        ("sise_revenue_rate", cell_at(t, 2, 1)),
        ("sise_siga_tot", _int_cell(t, 3, 1)),
        ("sise_siga_tot2", _int_cell(t, 4, 1)),
        ("sise_issue_stock_normal", cell_at(t, 6, 1)),
    ], df.columns if keep is None else keep)


def consensus(df: DataFrame, tables: str = "tables", keep: list[str] | None = None) -> DataFrame:
    """V3: table 7 row 0: opinion, target price, EPS (with commas), PER, agency count."""
    t = F.col("_t7")
    return sequential(_viewed(df, tables, (7,)), [
        ("toja_discision", cell_at(t, 0, 0)),
        ("toja_prop_price", _int_cell(t, 0, 1)),
        ("toja_eps", _int_cell(t, 0, 2)),
        ("toja_per", cell_at(t, 0, 3)),
        ("toja_comp", let(cell_at(t, 0, 4), _int_text).cast("string")),
    ], df.columns if keep is None else keep)


def required_return(rate_cells: DataFrame, row: int = RATE_ROW, column: str = RATE_COLUMN):
    """V1 + J9: (k, displayed) as scalar-subquery columns: the cell at
    (row, column) of the rate table as a percent, else 20.0 shown as '-'.
    The cell is found by one partial aggregation over the long cell form; the
    scalar is then applied to every stock without a join."""
    hit = (F.col("row_no") == row) & (F.col("header") == column)
    val = rate_cells.select(F.max(F.when(hit, _num(F.col("cell")))))
    k = val.scalar()
    return F.coalesce(k, F.lit(DEFAULT_REQUIRED_RETURN)), F.coalesce(k.cast("string"), F.lit(MISSING))


SRIM_FIELDS = ["srim_revenue_rate", "srim_jibea", "srim_roa", "srim_roe", "srim_value",
               "srim_issue_stock", "srim_prop_price", "srim_10_price", "srim_20_price"]


def srim(df: DataFrame, k: Column, k_shown: Column, issue_col: str = "sise_issue_stock_normal",
         tables: str = "tables", keep: list[str] | None = None) -> DataFrame:
    """V4: S-RIM fair value and the two decay scenarios (operation order kept,
    doubles throughout; displayed prices truncated toward zero). Staged
    projections: inputs, then value/shares, then prices, then the W5 fill."""
    keep = keep if keep is not None else [c for c in df.columns if c != tables]
    four, ten, treas_cell = F.col("_t4"), F.col("_t10"), F.col("_treasury_cell")
    s0 = _viewed(df, tables, (4, 10)).select(
        *keep, k.alias("_k"), k_shown.alias("srim_revenue_rate"),
        row_at(ten, 9).alias("_r9"), row_at(ten, 16).alias("_r16"), row_at(ten, 17).alias("_r17"),
        parse_shares(F.col(issue_col)).alias("_issued"), cell_at(four, 4, TREASURY_COLUMN).alias("_treasury_cell"))
    s1 = s0.select(
        *keep, "_k", "srim_revenue_rate",
        (F.col("_r9").isNotNull() & F.col("_r16").isNotNull() & F.col("_r17").isNotNull()).alias("_have"),
        last_valid_in(F.transform("_r9", _num)).alias("_equity"),
        last_valid_in(F.transform(F.slice("_r16", 2, 4), _num)).alias("_roa"),
        last_valid_in(F.transform(F.slice("_r17", 2, 4), _num)).alias("_roe"),
        "_issued",
        F.when(treas_cell.isNull(), F.lit(None))
         .when((F.trim(treas_cell) == "") | (F.lower(F.trim(treas_cell)) == "nan"), F.lit(0))
         .otherwise(_int_text(treas_cell)).alias("_treasury"))
    equity, roa, roe, kk = F.col("_equity"), F.col("_roa"), F.col("_roe"), F.col("_k")
    s2 = s1.select(
        "*",
        F.when(roe - roa > ROE_ROA_SWITCH, roa).otherwise(roe).alias("_basis"),
        F.try_multiply(equity + F.try_divide(equity * (roe - kk), kk), F.lit(UNIT)).alias("_value"),
        F.try_subtract(F.col("_issued"), F.col("_treasury")).alias("_shares"))
    shares = F.col("_shares").cast("double")
    s3 = s2.select("*", F.try_divide(F.col("_value"), shares).alias("_fair"),
                   (equity * (F.col("_basis") - kk) / 100).alias("_excess"))

    def scenario(w):
        kept = F.try_divide(F.lit(w), F.lit(1.0) + kk / 100 - F.lit(w))
        p = F.try_divide((equity + F.col("_excess") * kept) * F.lit(UNIT), shares)
        return F.when(F.col("_excess") < 0, F.col("_fair") - (p - F.col("_fair"))).otherwise(p)

    fair, value = F.col("_fair"), F.col("_value")
    return sequential(s3, [
        ("srim_jibea", F.when(F.col("_have"), fmt_float(equity))),
        ("srim_roa", roa.cast("string")),
        ("srim_roe", roe.cast("string")),
        ("srim_value", F.when(~F.isnan(value), fmt_float(value))),
        ("srim_issue_stock", fmt_int(F.col("_shares"))),
        ("srim_prop_price", F.when(fair.isNotNull() & ~F.isnan(fair), fmt_int(fair))),
        ("srim_10_price", fmt_int(scenario(DECAY_WEIGHTS[0]))),
        ("srim_20_price", fmt_int(scenario(DECAY_WEIGHTS[1]))),
    ], keep + ["srim_revenue_rate"])


def company_profile(html: Column, first=("span", "stxt1"), second=("span", "stxt2"),
                    names=("ticker_desc1", "ticker_desc2")) -> list[Column]:
    """V5: two descriptive labels per page (text of the first matching element), in order: a
    missing first one leaves both at '-'."""
    one, two = first_text(html, *first), first_text(html, *second)
    return [F.coalesce(one, F.lit(MISSING)).alias(names[0]),
            F.when(one.isNotNull(), F.coalesce(two, F.lit(MISSING))).otherwise(F.lit(MISSING)).alias(names[1])]

"""Rendered company pages from ``part`` (one HTML page per part row).

Cell values are SQL expressions over part's columns written in the dialect
subset Spark SQL and DuckDB share, so both engines derive identical inputs.
Rendering is per row (concat) - no grouping. The oracle never parses this
HTML; it computes the expected fields straight from part's columns.

  table 0  market snapshot   rows 0..6, columns (th label, value); numbers have commas, one
                             in 103 is beyond a long
  table 4  share structure   row 4 = treasury shares, column '보통주'
  table 7  consensus         row 0: opinion, target, EPS, PER, agencies
  table 10 financial summary rows 9 (equity), 16 (ROA), 17 (ROE); columns 1..8
  other tables are one-cell placeholders so table numbers line up; on every tenth page 6 is nested in 5.
"""
from __future__ import annotations

K, S, R = "p_partkey", "p_size", "p_retailprice"


def _i(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _fl(expr: str) -> str:
    return f"CAST(CAST(floor({expr}) AS BIGINT) AS STRING)"


def _comma(n: str) -> str:
    """A non-negative integer expression with thousands commas, up to nine digits."""
    rest, mid = f"lpad({_i(f'({n}) % 1000')}, 3, '0')", f"lpad({_fl(f'(({n}) % 1000000) / 1000')}, 3, '0')"
    return (f"CASE WHEN {n} >= 1000000 THEN {_fl(f'({n}) / 1000000')} || ',' || {mid} || ',' || {rest} "
            f"WHEN {n} >= 1000 THEN {_fl(f'({n}) / 1000')} || ',' || {rest} ELSE {_i(n)} END")


ISSUED = f"1000000 + ({K} % 97) * 1000"
ISSUED_TEXT = f"'1,' || lpad({_i(f'{K} % 97')}, 3, '0') || ',000'"

SNAPSHOT = [  # (label, value) per body row 0..6
    ("'주가'", _fl(R)),
    ("'52주'", f"{_fl(R + ' * 1.2')} || '/' || {_fl(R + ' * 0.8')}"),
    ("'수익률'", _i(f"{S} - 25")),
    ("'시가총액'", f"CASE WHEN {S} % 11 = 0 THEN 'N/A' ELSE {_comma(f'{K} * 1000 + {S}')} END"),
    ("'시가총액2'", f"CASE WHEN {K} % 103 = 0 THEN '99999999999999999999' ELSE {_comma(f'{K} * 7')} END"),
    ("'거래량'", _i(f"{S} * 3")),
    ("'발행주식수'", f"{ISSUED_TEXT} || '/ ' || {_i(S)}"),
]
TREASURY = (f"CASE WHEN {K} % 101 = 0 THEN {_i(ISSUED)} WHEN {K} % 5 = 0 THEN '' "
            f"ELSE {_comma(f'{S} * 100')} END")
CONSENSUS = [
    f"CASE {S} % 3 WHEN 0 THEN '매수' WHEN 1 THEN '중립' ELSE '매도' END",
    f"CASE WHEN {S} % 13 = 0 THEN '-' ELSE {_comma(f'CAST(floor({R} * 13) AS BIGINT)')} END",
    _i(f"{S} * 37"),
    _i(f"CAST({S} % 40 AS DOUBLE) / 4"),
    _i(f"{S} % 10"),
]
SUMMARY_STATUS = f"CASE WHEN {K} % 5 = 0 THEN '' ELSE '<h3>' || p_type || '</h3>' END"
SUMMARY_ITEM = "'<li class=\"a\">동사는 ' || p_brand || '</li>'"
PERIODS = ["2019", "2020", "2021", "2022", "2023E", "2024E", "2025E", "2026E"]


def equity_cell(c: int) -> str:
    parts = []
    if c >= 7:
        parts.append(f"WHEN {K} % 7 = 0 THEN 'NaN'")
    if c == 8:
        parts.append(f"WHEN {K} % 3 = 0 THEN ''")
    val = _i(f"{R} + {c * 10}")
    return f"CASE {' '.join(parts)} ELSE {val} END" if parts else val


def roa_cell(c: int) -> str:
    if c > 4:
        return "'99.0'"
    val = _i(f"CAST({S} - {K} % 9 AS DOUBLE) + ({(c - 4) * 0.5})")
    return f"CASE WHEN {K} % 4 = 0 THEN '' ELSE {val} END" if c == 4 else val


def roe_cell(c: int) -> str:
    if c > 4:
        return "'99.0'"
    return _i(f"CAST({S} AS DOUBLE) + ({(c - 4) * 0.5})")


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _row(cells: list, tags: list[str]) -> list[str]:
    """A cell is an expression, or (expression, attributes of its tag)."""
    out = [_lit("<tr>")]
    for cell, tag in zip(cells, tags):
        value, attrs = cell if isinstance(cell, tuple) else (cell, "")
        out += [_lit(f"<{tag}{attrs}>"), value, _lit(f"</{tag}>")]
    return out + [_lit("</tr>")]


def _table(header: list[str], rows: list[list], thead: bool = False, labels: bool = False) -> list[str]:
    """``labels``: each body row's first cell is a th."""
    out = [_lit("<table>")] + ([_lit("<thead>")] if thead else [])
    out += _row([_lit(h) for h in header], ["th"] * len(header)) + ([_lit("</thead>")] if thead else [])
    for r in rows:
        out += _row(r, ["th" if labels else "td"] + ["td"] * (len(r) - 1))
    return out + [_lit("</table>")]


def company_html_pieces() -> list[str]:
    """The page as a flat list of SQL expression pieces (concatenated n-ary,
    so the expression tree stays shallow)."""
    placeholder = [_lit("<table><tr><td>-</td></tr></table>")]
    t0 = _table(["항목", "값"], [[lab, val] for lab, val in SNAPSHOT], labels=True)
    # a label over two rows, a value over two columns
    t4 = _table(["구분", "보통주", "우선주"],
                [[("'r0'", ' rowspan="2"'), "'0'", "'0'"], [("'0'", ' colspan="2"')], ["'r2'", "'0'", "'0'"], ["'r3'", "'0'", "'0'"],
                 ["'자기주식'", TREASURY, "'0'"]])
    t7 = _table(["투자의견", "목표주가", "EPS", "PER", "추정기관수"], [CONSENSUS])
    rows10 = []
    for r in range(18):
        if r == 9:
            rows10.append(["'지배주주지분'"] + [equity_cell(c) for c in range(1, 9)])
        elif r == 16:
            rows10.append(["'ROA'", (roa_cell(1), ' colspan="2"')] + [roa_cell(c) for c in range(3, 9)])
        elif r == 17:
            rows10.append(["'ROE'"] + [roe_cell(c) for c in range(1, 9)])
        else:
            rows10.append([f"'항목{r}'"] + ["''"] * 8)
    t10 = _table(["IFRS"] + PERIODS, rows10, thead=True, labels=True)
    # every ninth page lacks the first label
    spans = [f"CASE WHEN {K} % 9 = 0 THEN '' ELSE '<span class=\"stxt stxt1\">' || p_type || '</span>' END",
             _lit('<span class="stxt stxt2">'), "p_brand", _lit("</span>")]
    # tables 5 and 6: on every tenth page one stands in a cell of the other
    inside, apart = "<table><tr><td>-<table><tr><td>inner</td></tr></table>after</td></tr></table>", _unlit(placeholder[0]) * 2
    nested = [f"CASE WHEN {K} % 10 = 0 THEN {_lit(inside)} ELSE {_lit(apart)} END"]
    # every eighth page has no summary block, every fifth summary no status
    spans += [f"CASE WHEN {K} % 8 = 0 THEN '' ELSE '<div class=\"tab um_bssummary\">' || {SUMMARY_STATUS} || '<ul>' || {SUMMARY_ITEM} || '<li>x</li></ul></div>' END"]
    body = (t0 + placeholder * 3 + t4 + nested + t7 + placeholder * 2 + t10)
    return _merge([_lit("<html><body>")] + spans + body + [_lit("</body></html>")])


def _merge(pieces: list[str]) -> list[str]:
    """Fold adjacent string literals into one."""
    out: list[str] = []
    for p in pieces:
        if out and _is_lit(p) and _is_lit(out[-1]):
            out[-1] = _lit(_unlit(out[-1]) + _unlit(p))
        else:
            out.append(p)
    return out


def _is_lit(p: str) -> bool:
    return len(p) >= 2 and p[0] == "'" and p[-1] == "'" and "'" not in p[1:-1].replace("''", "")


def _unlit(p: str) -> str:
    return p[1:-1].replace("''", "'")


LISTING_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def listing_html_pieces() -> list[str]:
    """A one-table page per part: header = column names, one body row of values."""
    vals = [_i(c) for c in LISTING_COLS]
    return _merge([_lit("<html><body>")] + _table(LISTING_COLS, [vals]) + [_lit("</body></html>")])


def html_column(pieces: list[str]):
    from pyspark.sql import functions as F
    return F.concat(*[F.lit(_unlit(p)) if _is_lit(p) else F.expr(p) for p in pieces])


# Rate table cells (long form) from supplier: table 0, body row = s_suppkey,
# column '5년' holds a yield in percent.
RATE_CELL = "CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 9 + 5 AS STRING) || '.25'"

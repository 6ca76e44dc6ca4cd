"""Scans over stored web pages.

A page is one row; every scan here is a per-row regex extraction followed by a
``posexplode`` - no shuffle, no Python. Comments and scripts are read as markup; a
page that does not match simply yields no rows, the way the job skips a failing page.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let as _let
from ..functions.text import strip_tags, strip_ws


def _element_pattern(tag: str, css_class: str | None = None) -> str:
    if css_class is None:
        return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    cls = rf"""\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["']"""
    return rf"(?is)<{tag}\b[^>]*{cls}[^>]*>(.*?)</{tag}\s*>"


def elements(html: Column, tag: str, css_class: str | None = None) -> Column:
    """array<string> of inner HTML of every ``tag`` (optionally with ``css_class``)."""
    return F.regexp_extract_all(html, F.lit(_element_pattern(tag, css_class)), 1)


def _first_anchor_attr(inner: Column, attr: str) -> Column:
    """Attribute of the first <a> inside ``inner``; null when that anchor lacks it."""
    first_a = F.regexp_extract(inner, r"(?is)<a\b[^>]*>", 0)
    pat = rf"""(?is)\s{attr}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    val = F.concat(F.regexp_extract(first_a, pat, 1), F.regexp_extract(first_a, pat, 2))
    has = first_a.rlike(rf"(?is)\s{attr}\s*=\s*[\"']")
    return F.when(has, val)


def anchor_attrs(pages: DataFrame, attr: str, containers=("dd", "dt"), within: tuple[str, ...] = (),
                 id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """For each container tag in turn, the ``attr`` of the first anchor in each container
    element; entries whose first anchor lacks it are skipped. With ``within``, only containers
    inside these enclosing elements count, outermost first; ``tag#id`` asks for an id.

    Output: (id, slot, pos, value), pos 0-based among kept entries of the slot. One scan of
    the pages: all slots of a page are found in its row and exploded once.
    """
    scopes = F.array(F.col(html_col))
    for tag in within:
        tag, _, css_id = tag.partition("#")
        scopes = F.flatten(_inner_all(scopes, _scope_pattern(tag, css_id)))
    slots = [F.struct(F.lit(slot).alias("slot"), F.filter(
        F.transform(F.flatten(_inner_all(scopes, _element_pattern(slot))), lambda e: _first_anchor_attr(e, attr)),
        lambda v: v.isNotNull()).alias("values")) for slot in containers]
    found = pages.select(F.col(id_col), F.explode(F.array(*slots)).alias("s"))
    out = found.select(id_col, F.col("s.slot").alias("slot"), F.posexplode("s.values").alias("pos", "value"))
    return out.withColumn("value", _unescape_attr(F.col("value")))


def _inner_all(parts: Column, pattern: str) -> Column:
    return F.transform(parts, lambda h: F.regexp_extract_all(h, F.lit(pattern), 1))


def _scope_pattern(tag: str, css_id: str) -> str:
    """An element that may hold others of other tags; with an id, everything after its start
    up to the last end tag of its kind."""
    if not css_id:
        return rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"
    return rf"""(?is)<{tag}\b[^>]*\bid\s*=\s*["']{css_id}["'][^>]*>(.*)</{tag}\s*>"""


def _unescape_attr(c: Column) -> Column:
    from ..functions.text import unescape_html
    return unescape_html(c)


def class_text(pages: DataFrame, tag: str, css_class: str,
               id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Text of every ``tag`` element carrying ``css_class``: (id, pos, text)."""
    return pages.select(F.col(id_col), F.posexplode(
        F.transform(elements(F.col(html_col), tag, css_class), strip_tags)).alias("pos", "text"))


def first_text(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Text of the first matching element, null when there is none."""
    return strip_tags(F.get(elements(html, tag, css_class), 0))


# --- tables ---------------------------------------------------------------
# Three splits read a page, each over what the one before has left whole: at table tags, at row
# starts, at cell starts. A cell stays markup (``cell_text`` reads it) until a job asks for it.
# Each pattern starts with a plain character, which is searched for fast; the pieces get it back.
_TABLE_TAG = r"(?i)<(?=/?table\b)"
_ROW_START = r"(?i)<(?=tr\b)"
_CELL_START = r"(?i)<(?=t[dh]\b)"
_CELL_BODY = r"(?is)^<t[dh]\b[^>]*>(.*?)(?:</(?:t[dhr]|thead|tbody|tfoot|table)\b|$)"
#: The HTML standard's largest spans.
MOST_SPANNED = {"colspan": 1000, "rowspan": 65534}


def _cut(markup: Column, pattern: str) -> Column:
    """array<string>: the pieces of markup that start where the pattern matches."""
    # the first piece is what stands before the first match; a slice ends with its array
    return F.transform(F.slice(F.split(markup, pattern, -1), 2, 1 << 30), lambda p: F.concat(F.lit("<"), p))


def cell_text(cell: Column) -> Column:
    """Text of a cell's markup: tags dropped, entities decoded, white space stripped at the ends."""
    return _let(F.regexp_extract(cell, _CELL_BODY, 1), lambda t: strip_ws(
        F.when(t.contains("<") | t.contains("&"), strip_tags(t)).otherwise(t)))


def _opens(segment: Column) -> Column:
    return F.substring(segment, 2, 1) != "/"


def _own_markup(segments: Column) -> Column:
    """array<string> of the markup of each table, in order of their start tags, from the pieces
    of a page cut at table tags. A fold with a stack: an end tag closes the table opened last,
    whose text then stands in the cell around it; what is left open ends with the page."""
    entry = "struct<no: int, html: string>"
    start = F.struct(F.lit(0).alias("next"), F.expr(f"cast(array() as array<{entry}>)").alias("open"),
                     F.expr(f"cast(array() as array<{entry}>)").alias("done"))

    def state(next_: Column, open_: Column, done: Column) -> Column:
        return F.struct(next_.alias("next"), open_.alias("open"), done.alias("done"))

    def with_tail(stack: Column, tail: Column) -> Column:
        """The stack, with ``tail`` added to its last table."""
        last = F.get(stack, F.size(stack) - 1)
        longer = F.struct(last["no"].alias("no"), F.concat(last["html"], tail).alias("html"))
        return F.when(F.size(stack) > 0, F.concat(F.slice(stack, 1, F.size(stack) - 1), F.array(longer))).otherwise(stack)

    def step(st: Column, seg: Column) -> Column:
        pushed = state(st["next"] + 1, F.concat(st["open"], F.array(F.struct(st["next"].alias("no"), seg.alias("html")))), st["done"])
        last = F.get(st["open"], F.size(st["open"]) - 1)
        text = F.concat(F.regexp_replace(last["html"], r"<[^>]*>", ""), F.regexp_replace(seg, r"(?s)^[^>]*>", ""))
        popped = state(st["next"], with_tail(F.slice(st["open"], 1, F.size(st["open"]) - 1), text), F.concat(st["done"], F.array(last)))
        return F.when(_opens(seg), pushed).when(F.size(st["open"]) > 0, popped).otherwise(st)

    closed = F.aggregate(segments, start, step, lambda st: F.concat(st["done"], st["open"]))
    return F.transform(F.array_sort(closed), lambda t: t["html"])


def _tables_of(html: Column) -> Column:
    """array<string>: markup of each table of a page, nested ones included."""
    def read(s: Column) -> Column:
        nested = F.exists(F.transform(s, lambda x, i: _opens(x) & F.coalesce(_opens(F.get(s, i + 1)), F.lit(False))), lambda x: x)
        return F.when(nested, _own_markup(s)).otherwise(F.filter(s, _opens))
    return _let(_cut(html, _TABLE_TAG), read)


def _mentions(markup: Column, name: str) -> Column:
    """A cheap test before a pattern is tried."""
    return F.lower(markup).contains(name)


def _span(cell: Column, name: str) -> Column:
    n = F.regexp_extract(cell, rf"""(?is)^<t[dh]\b[^>]*\b{name}\s*=\s*["']?([0-9]+)""", 1).try_cast("int")
    return F.when(_mentions(cell, name), F.least(F.lit(MOST_SPANNED[name]), F.greatest(F.lit(1), F.coalesce(n, F.lit(1))))).otherwise(1)


def _row_cells(row: Column) -> Column:
    """Cells of a row's markup; one that spans columns is copied."""
    own = _cut(row, _CELL_START)
    return F.when(_mentions(row, "colspan"), F.flatten(F.transform(own, lambda c: F.array_repeat(c, _span(c, "colspan"))))).otherwise(own)


def _spread_rows(rows: Column) -> Column:
    """Copies cells that span rows into the rows below: they take their columns there, and a
    row's own cells fill the columns that are left."""
    start = F.struct(F.expr("cast(array() as array<array<string>>)").alias("out"),
                     F.expr("cast(array() as array<struct<col: int, cell: string, rows: int>>)").alias("open"))

    def add(state, row):
        cols = F.sequence(F.lit(0), F.size(row) + F.size(state["open"]))
        taken = F.transform(state["open"], lambda o: o["col"])

        def place(free: Column) -> Column:
            own = F.transform(row, lambda c, i: F.struct(F.get(free, i).alias("col"), c.alias("cell"), _span(c, "rowspan").alias("rows")))
            return F.array_sort(F.concat(own, state["open"]))  # columns differ

        def next_state(placed: Column) -> Column:
            again = F.filter(placed, lambda p: p["rows"] > 1)
            return F.struct(F.concat(state["out"], F.array(F.transform(placed, lambda p: p["cell"]))).alias("out"),
                            F.transform(again, lambda p: F.struct(p["col"].alias("col"), p["cell"].alias("cell"), (p["rows"] - 1).alias("rows"))).alias("open"))
        plain = (F.size(state["open"]) == 0) & ~F.exists(row, lambda c: _span(c, "rowspan") > 1)
        return F.when(plain, F.struct(F.concat(state["out"], F.array(row)).alias("out"), state["open"].alias("open"))).otherwise(
            _let(_let(F.array_except(cols, taken), place), next_state))
    return F.aggregate(rows, start, add, lambda st: st["out"])


def table_markups(html: Column, css_class: str | None = None) -> Column:
    """array<string>: markup of each table of a page (with ``css_class`` if given), numbered by
    their start tags, nested ones too. A cell around a nested table holds its text, and the nested
    table's rows are its own alone."""
    tables = _tables_of(html)
    if css_class is not None:
        own = rf"""(?is)^<table\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""
        tables = F.filter(tables, lambda t: t.rlike(own))
    return tables


def table_view(table: Column) -> Column:
    """struct(header array<string>, rows array<string>) of a table's markup. Header labels are
    texts; body rows stay markup, cut into cells only when one is asked for.

    The header is a ``thead``'s last row, or else the last of the leading rows made of ``th``
    cells only; body rows are numbered from 0 after it (how a table reader indexes a frame). A row
    of a ``th`` label and ``td`` values is a body row. Cells that span columns or rows are
    copied. End tags of rows and cells may be missing. Everything stays inside the page's row."""
    def spread(rows: Column) -> Column:
        # copies are made, so the spans in the tags have had their effect
        plain = lambda c: F.regexp_replace(c, r"(?is)^<(t[dh])\b[^>]*>", "<$1>")
        return F.transform(_spread_rows(F.transform(rows, _row_cells)), lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, plain), "")))

    def read(rows: Column) -> Column:
        in_head = F.when(_mentions(table, "<thead"), F.regexp_count(F.get(F.split(table, r"(?i)</thead\b", 2), 0), F.lit(r"(?i)<tr\b"))).otherwise(0)
        full = F.when(_mentions(table, "rowspan"), _let(rows, spread)).otherwise(rows)
        return _let(full, lambda r: _let(F.greatest(in_head, _leading_headers(r)), lambda n: F.struct(
            F.when(n > 0, F.transform(_row_cells(F.get(r, n - 1)), cell_text)).otherwise(F.array().cast("array<string>")).alias("header"),
            F.slice(r, n + 1, F.greatest(F.size(r) - n, F.lit(0))).alias("rows"))))
    return _let(_cut(table, _ROW_START), read)


def _leading_headers(rows: Column) -> Column:
    """How many rows at the top hold th cells only."""
    def only_th(row: Column) -> Column:
        return _let(F.lower(row), lambda r: r.rlike(r"<th\b") & ~r.contains("<td"))

    body = F.array_position(F.transform(rows, lambda r: ~only_th(r)), True).cast("int")
    # mostly none or one: the first two rows tell
    many = F.when(body > 0, body - 1).otherwise(F.size(rows))
    second = F.coalesce(only_th(F.get(rows, 1)), F.lit(False))
    return F.when(~F.coalesce(only_th(F.get(rows, 0)), F.lit(False)), 0).when(~second, 1).otherwise(many)


def cell_at(view: Column, row_no: int, col) -> Column:
    """Text of the cell (body row, column) of a ``table_view``; ``col`` is a 0-based
    index or a header label. Null when out of range."""
    cells = _row_cells(F.get(view["rows"], row_no))
    if isinstance(col, str):
        idx = F.array_position(view["header"], F.lit(col)) - 1
        return cell_text(F.when(idx >= 0, F.get(cells, idx.cast("int"))))
    return cell_text(F.get(cells, col))


def row_at(view: Column, row_no: int) -> Column:
    """Texts of a body row's cells."""
    return F.transform(_row_cells(F.get(view["rows"], row_no)), cell_text)


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                css_class: str | None = None, links: bool = False) -> DataFrame:
    """S3: long cell form (id, table_no, row_no, col_no, header, cell[, link]) of every table;
    ``link`` is the address of a cell's first anchor."""
    # an inner explode would be preceded by a filter on its array's size, so that each page, table
    # and row was read three times more; the outer one's only extra rows have no position
    m = pages.select(F.col(id_col), F.posexplode_outer(table_markups(F.col(html_col), css_class)).alias("table_no", "m"))
    t = m.where("table_no IS NOT NULL").select(id_col, "table_no", table_view(F.col("m")).alias("t"))
    r = t.select(id_col, "table_no", F.col("t.header").alias("hdr"), F.posexplode_outer("t.rows").alias("row_no", "r"))
    c = r.where("row_no IS NOT NULL").select(
        id_col, "table_no", "row_no", F.posexplode_outer(_row_cells(F.col("r"))).alias("col_no", "c"), "hdr").where("col_no IS NOT NULL")
    shown = [cell_text(F.col("c")).alias("cell")] + ([_first_anchor_attr(F.col("c"), "href").alias("link")] if links else [])
    return c.select(id_col, "table_no", "row_no", "col_no",
                    F.get(F.col("hdr"), F.col("col_no")).alias("header"), *shown)


def cells_to_fields(cells: DataFrame, spec: dict, id_col: str = "page_id") -> DataFrame:
    """S4 on the long form: one row per page, field = cell at (table, row, col)
    where col is an index or a header label. One aggregation pass."""
    aggs = []
    for name, (tno, rno, col) in spec.items():
        cond = (F.col("table_no") == tno) & (F.col("row_no") == rno)
        cond = cond & ((F.col("header") == col) if isinstance(col, str) else (F.col("col_no") == col))
        aggs.append(F.max(F.when(cond, F.col("cell"))).alias(name))
    return cells.groupBy(id_col).agg(*aggs)


def pick_first(cells: DataFrame, min_cells: int, needle_col: int, needle: str,
               link_col: int, prefix: str = "", drop: str | None = None,
               id_col: str = "page_id", row_col: str = "row_no") -> DataFrame:
    """In each page's index table (cells with their links), the first row (by row
    number) having more than ``min_cells`` cells and ``needle`` inside cell ``needle_col``;
    returns ``prefix`` and the address that cell ``link_col`` links to, with ``drop`` removed.
    Partial aggregation (min_by) keeps a page with a huge index cheap."""
    per_row = (cells.groupBy(id_col, row_col)
               .agg(F.count(F.lit(1)).alias("n_cells"),
                    F.max(F.when(F.col("col_no") == needle_col, F.col("cell"))).alias("needle_cell"),
                    F.max(F.when(F.col("col_no") == link_col, F.col("link"))).alias("link_cell")))
    hit = per_row.filter((F.col("n_cells") > min_cells) & F.col("needle_cell").contains(needle))
    link = F.concat(F.lit(prefix), F.col("link"))
    if drop:
        link = F.replace(link, F.lit(drop), F.lit(""))
    return (hit.groupBy(id_col).agg(F.min_by("link_cell", row_col).alias("link"))
            .select(id_col, link.alias("link")))

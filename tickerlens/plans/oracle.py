"""DuckDB SQL for every registered query (the independent correctness oracle).

Each query is written from the semantics, in plain SQL over the driver's
tables; the adapter CTEs mirror ``plans/adapters.py`` literally. Fixed values
(patterns, word lists) are imported from the modules that define them so both
sides use one spelling.
"""
from __future__ import annotations

from ..functions.text import CLEAN_PATTERN, WS
from . import adapters as A


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tone_case() -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in A.TONE.items())
    return f"CASE event_type {whens} ELSE {_q(A.TONE_DEFAULT)} END"


CTE = {}
CTE["headlines"] = f"""headlines AS (
  SELECT event_id AS seq, CAST(ts AS DATE) AS run_date, event_id // 20 AS page_no,
         CASE WHEN event_id % 20 < 10 THEN 'dd' ELSE 'dt' END AS slot,
         event_id % 10 AS pos,
         (CASE WHEN event_id % 7 = 0 THEN 'Customer'
               WHEN event_id % 11 = 0 THEN 'Client ' || CAST(user_id AS VARCHAR)
               ELSE 'Customer ' || lpad(CAST(user_id AS VARCHAR), 9, '0') END)
         || ', ' || event_type || '-' || CAST(user_id AS VARCHAR)
         || (CASE WHEN event_id % 3 = 0
                  THEN ' (' || upper(substr(event_type, 1, CAST(1 + event_id % 6 AS INTEGER))) || ')'
                  ELSE '' END)
         || {_tone_case()} AS title,
         ts, user_id, event_type
  FROM events)"""
CTE["master"] = """master AS (
  SELECT replace(c_name, '#', ' ') AS name, printf('%06d', c_custkey) AS code, CAST(c_custkey AS BIGINT) AS row_no
  FROM customer)"""
CTE["quotes"] = """quotes AS (
  SELECT printf('%06d', l_partkey) AS code, l_shipdate AS date,
         CAST(trunc(l_extendedprice) AS BIGINT) AS close,
         CAST(trunc(l_quantity) AS BIGINT) AS diff,
         CAST(trunc(l_extendedprice * (1 - l_discount)) AS BIGINT) AS open,
         CAST(trunc(l_extendedprice * (1 + l_tax)) AS BIGINT) AS high,
         CAST(trunc(l_extendedprice * (1 - l_discount - l_tax)) AS BIGINT) AS low,
         CASE WHEN l_linenumber <> 7 THEN CAST(trunc(l_quantity * l_linenumber) AS BIGINT) END AS volume,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem)"""
CTE["store"] = f"""store AS (
  SELECT e.event_id AS seq, printf('%06d', e.user_id) AS code_,
         strftime(e.ts, '%Y-%m-%d') AS date_,
         CASE WHEN d.doc_id IS NULL THEN NULL
              WHEN d.doc_id % 5 = 0 THEN d.text || ' Error'
              WHEN d.doc_id % 5 = 1 THEN {_q(A.FAILURE_TEXT)}
              WHEN d.doc_id % 5 = 2 THEN d.text || ' 에러 발생'
              ELSE d.text END AS report_
  FROM events e LEFT JOIN documents d ON e.event_id = d.doc_id
  WHERE e.event_type IN ('purchase', 'view'))"""
CTE["store_all"] = CTE["store"].replace("store AS (", "store_all AS (", 1).replace("\n  WHERE e.event_type IN ('purchase', 'view')", "")
_replies = ", ".join(_q(r) for r in A.REPLIES)
CTE["replies"] = f"""replies AS (
  SELECT seq, title,
         CASE WHEN seq % 13 < {len(A.REPLIES)} THEN ([{_replies}])[CAST(seq % 13 AS INTEGER) + 1]
              ELSE title END AS reply
  FROM headlines)"""
CTE["corpus"] = """corpus AS (
  SELECT d.doc_id AS id, d.text AS document, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
# Master deduplicated by name (last row wins) and the latest quote per code.
CTE["master_d"] = """master_d AS (
  SELECT name, arg_max(code, row_no) AS code FROM master GROUP BY name)"""
CTE["latest"] = """latest AS (
  SELECT code, date, close, diff, open, high, low, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC, l_orderkey DESC,
             l_linenumber DESC, l_partkey DESC, l_suppkey DESC, close DESC, diff DESC,
             open DESC, high DESC, low DESC, volume DESC) AS rn
    FROM quotes WHERE date IS NOT NULL AND volume IS NOT NULL) WHERE rn = 1)"""
CTE["keyed"] = f"""keyed AS (
  SELECT h.*, regexp_replace(split_part(h.title, ',', 1), {_q(CLEAN_PATTERN)}, '', 'g') AS key
  FROM headlines h)"""
CTE["linked"] = """linked AS (
  SELECT k.*, m.code, m.name, replace(k.title, '-', '') AS content
  FROM keyed k JOIN master_d m ON k.key = m.name)"""

DEPS = {
    "replies": ["headlines"], "keyed": ["headlines"], "master_d": ["master"],
    "latest": ["quotes"], "linked": ["keyed", "master_d"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


QUOTE_COLS = "close, diff, open, high, low, volume"
WS_CLASS = WS

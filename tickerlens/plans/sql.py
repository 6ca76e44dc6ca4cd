"""Oracle SQL (DuckDB) per registered query; keys match ``queries.QUERIES``."""
from __future__ import annotations

from .oracle import with_ctes

SQL: dict[str, str] = {}

SQL["linked_quotes"] = with_ctes(["linked", "latest"], f"""
SELECT l.seq, strftime(l.run_date, '%Y-%m-%d') AS run_date, l.code, l.name, l.content,
       coalesce(q.close, 0) AS close, coalesce(q.diff, 0) AS diff, coalesce(q.open, 0) AS open,
       coalesce(q.high, 0) AS high, coalesce(q.low, 0) AS low, coalesce(q.volume, 0) AS volume
FROM linked l LEFT JOIN latest q ON q.code = l.code""")

# --- scalars -----------------------------------------------------------------
from ..functions.language import (EN_POLARITY, EN_STATEMENT, ENGLISH_PATTERN,  # noqa: E402
                                  KO_POLARITY, KO_STATEMENT, KOREAN_PATTERN)
from ..functions.text import CLEAN_PATTERN, HANGUL_KEEP, WS  # noqa: E402
from ..operators.store import ERROR_PATTERN, FAILURE_MARK  # noqa: E402
from .oracle import _q  # noqa: E402

WSR = f"[{WS}]+"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {_q(f'^[{WS}]+|[{WS}]+$')}, '', 'g')"


SQL["clean_text"] = f"SELECT doc_id, regexp_replace(text, {_q(CLEAN_PATTERN)}, '', 'g') AS cleaned FROM documents"
SQL["headline_key"] = with_ctes(["keyed"], "SELECT seq, key, replace(title, '-', '') AS content FROM keyed")
SQL["extract_ticker"] = with_ctes(["headlines"], r"""
SELECT src, id, ticker FROM (
  SELECT src, id, regexp_extract(text, '\(([^)]*)', 1) AS ticker, text FROM (
    SELECT 'headline' AS src, seq AS id, title AS text FROM headlines
    UNION ALL SELECT 'document', doc_id, text FROM documents))
WHERE strpos(text, '(') > 0 AND length(ticker) <= 4""")
SQL["truncate_words"] = f"""
SELECT doc_id, CASE WHEN len(w) <= 20 THEN text ELSE array_to_string(w[1:20], ' ') || '...' END AS truncated
FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(text, {_q(WSR)}), lambda x: x <> '') AS w
      FROM documents)"""
SQL["normalise_ws"] = f"""
SELECT doc_id, regexp_replace(replace(text, chr(10), ' '), {_q(WSR)}, ' ', 'g') AS normalised FROM documents"""
SQL["section_after"] = """
SELECT doc_id, CASE WHEN strpos(text, '. ') > 0 THEN split_part(text, '. ', 2) END AS section FROM documents"""
SQL["keep_alnum_hangul"] = f"""
SELECT doc_id, regexp_replace(text, {_q(f'[^{HANGUL_KEEP}{WS}]+')}, '', 'g') AS kept FROM documents"""
SQL["last_paragraph"] = f"""
SELECT doc_id, {strip_sql("string_split(text, chr(10))[-1]")} AS last_block FROM documents"""


def verdict_sql(col: str, neutral: str) -> str:
    def branch(pol, stmt):
        p, n = pol
        cond = f"(contains({col}, {_q(p)}) AND contains({col}, {_q(n)}))"
        for s in stmt:
            cond += f" OR contains({col}, {_q(s)})"
        return (f"CASE WHEN {cond} THEN {_q(neutral)} WHEN strpos({col}, {_q(n)}) = 0 THEN 'P' "
                f"WHEN strpos({col}, {_q(n)}) = 1 THEN {_q(neutral)} ELSE 'N' END")
    return (f"CASE WHEN regexp_matches({col}, {_q(KOREAN_PATTERN)}) THEN {branch(KO_POLARITY, KO_STATEMENT)} "
            f"WHEN regexp_matches({col}, {_q(ENGLISH_PATTERN)}) THEN {branch(EN_POLARITY, EN_STATEMENT)} "
            f"WHEN {col} IS NOT NULL THEN {_q(neutral)} END")


SQL["detect_language"] = with_ctes(["replies"], f"""
SELECT seq, regexp_matches(reply, {_q(KOREAN_PATTERN)}) AS is_korean,
       regexp_matches(reply, {_q(ENGLISH_PATTERN)}) AS is_english,
       CASE WHEN regexp_matches(reply, {_q(KOREAN_PATTERN)}) THEN 'Korean'
            WHEN regexp_matches(reply, {_q(ENGLISH_PATTERN)}) THEN 'English' ELSE 'Unknown' END AS language
FROM replies""")
SQL["verdict_pn"] = with_ctes(["replies"], f"SELECT seq, reply, {verdict_sql('reply', 'P')} AS pn FROM replies")
SQL["verdict_pnc"] = with_ctes(["replies"], f"SELECT seq, reply, {verdict_sql('reply', 'C')} AS pnc FROM replies")
SQL["sentences_findall"] = f"""
SELECT conv_id, turn, CAST(len(s) AS BIGINT) AS n_sentences, {strip_sql("s[1]")} AS first_sentence
FROM (SELECT conv_id, turn, regexp_extract_all(text, '.+?[.?!]') AS s FROM conversations)"""
SQL["format_numbers"] = """
SELECT l_extendedprice, format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT)) AS price_text,
       format('{:,}', CAST(trunc(l_extendedprice * -7.5) AS BIGINT)) AS neg_text
FROM lineitem"""
SQL["parse_share_count"] = """
SELECT o_orderkey, CAST(trunc(o_totalprice * 100) AS BIGINT) AS shares FROM orders"""
SQL["run_keys"] = """
SELECT event_id, strftime(ts, '%Y%m%d') || strftime(ts, '%H%M') || printf('%06d', user_id) AS key_,
       strftime(ts, '%Y%m%d') || printf('%06d', user_id) AS detail_key,
       strftime(ts, '%Y-%m-%d') AS date_, strftime(ts, '%H:%M') AS time_
FROM events"""
SQL["error_report_predicates"] = with_ctes(["store_all"], f"""
SELECT seq, report_ NOT LIKE {_q('%' + FAILURE_MARK + '%')} AS reusable,
       regexp_matches(report_, {_q(ERROR_PATTERN)}) AS purge
FROM store_all""")

# --- joins, sets, windows ----------------------------------------------------
from .oracle import CTE, DEPS  # noqa: E402

SQL["link_candidates"] = with_ctes(["keyed", "master_d"], """
SELECT k.seq, k.key, (SELECT count(*) FROM master_d m WHERE contains(m.name, k.key)) AS n_candidates
FROM keyed k""")
SQL["link_carry_forward"] = with_ctes(["keyed", "master_d"], """
SELECT seq, strftime(run_date, '%Y-%m-%d') AS run_date, key, code, name, exact FROM (
  SELECT seq, run_date, key, n_cand,
         coalesce(last_value(xcode IGNORE NULLS) OVER w, '') AS code,
         coalesce(last_value(xname IGNORE NULLS) OVER w, '') AS name,
         xcode IS NOT NULL AS exact
  FROM (SELECT k.seq, k.run_date, k.key, m.code AS xcode, m.name AS xname,
               (SELECT count(*) FROM master_d m2 WHERE contains(m2.name, k.key)) AS n_cand
        FROM keyed k LEFT JOIN master_d m ON k.key = m.name)
  WINDOW w AS (PARTITION BY run_date ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE n_cand > 0""")
SQL["new_only"] = with_ctes(["linked", "store"], """
SELECT l.seq, l.code, strftime(l.run_date, '%Y-%m-%d') AS run_day FROM linked l
WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.code_ = l.code AND s.date_ = strftime(l.run_date, '%Y-%m-%d'))""")
CTE["max_report"] = f"""max_report AS (
  SELECT code_, max(report_) AS stored_report FROM store
  WHERE report_ NOT LIKE {_q('%' + FAILURE_MARK + '%')} GROUP BY code_)"""
DEPS["max_report"] = ["store"]
SQL["reuse_reports"] = with_ctes(["linked", "max_report"], """
SELECT l.seq, l.code, coalesce(r.stored_report, '') AS report, length(coalesce(r.stored_report, '')) = 0 AS needs_report
FROM linked l LEFT JOIN max_report r ON r.code_ = l.code""")
SQL["count_by_code_date"] = with_ctes(["store_all"], "SELECT code_, date_, count(*) AS cnt FROM store_all GROUP BY code_, date_")
SQL["max_report"] = with_ctes(["store_all"], f"""
SELECT code_, max(report_) AS stored_report FROM store_all
WHERE report_ NOT LIKE {_q('%' + FAILURE_MARK + '%')} GROUP BY code_""")
SQL["dedupe_pages"] = """
SELECT min(doc_id) AS doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines
FROM documents GROUP BY string_split(text, chr(10)), text"""
CTE["lists"] = """lists AS (
  SELECT run_date, page_no, slot, list(title ORDER BY pos) AS titles FROM headlines
  GROUP BY run_date, page_no, slot)"""
DEPS["lists"] = ["headlines"]
SQL["dedupe_headline_lists"] = with_ctes(["lists"], """
SELECT h.seq, strftime(h.run_date, '%Y-%m-%d') AS run_date, h.page_no, h.slot, h.pos
FROM headlines h JOIN (
  SELECT arg_min(struct_pack(run_date := run_date, page_no := page_no, slot := slot),
                 struct_pack(a := date_diff('day', run_date, DATE '2100-01-01'), b := page_no, c := slot)) AS k
  FROM lists GROUP BY titles) f
ON h.run_date = f.k.run_date AND h.page_no = f.k.page_no AND h.slot = f.k.slot""")


def backfill_sql(n: int) -> str:
    return with_ctes(["lists"], f"""
SELECT strftime(run_date, '%Y-%m-%d') AS run_date, new_lists, lists_before, lists_before + new_lists AS lists_held
FROM (
  SELECT run_date, new_lists,
         CAST(coalesce(sum(new_lists) OVER (ORDER BY run_date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lists_before
  FROM (SELECT d.run_date, CAST(coalesce(p.new_lists, 0) AS BIGINT) AS new_lists
        FROM (SELECT DISTINCT run_date FROM lists) d
        LEFT JOIN (SELECT run_date, count(*) AS new_lists FROM
                     (SELECT titles, max(run_date) AS run_date FROM lists GROUP BY titles) GROUP BY run_date) p
        ON p.run_date = d.run_date))
WHERE lists_before < {n}""")


SQL["backfill_horizon"] = backfill_sql(10)
SQL["backfill_horizon_wide"] = backfill_sql(200)
SQL["crawl_plan"] = """
SELECT strftime(d, '%Y-%m-%d') AS run_date, p AS page_no, s AS slot
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), range(1, 10) t(p), (VALUES ('dd'), ('dt')) v(s)"""

# --- features and sentiment --------------------------------------------------
TOK = r"regexp_extract_all(lower({}), '\p{{L}}+')"
CTE["ctok"] = f"ctok AS (SELECT id, label, document, {TOK.format('document')} AS tokens FROM corpus)"
DEPS["ctok"] = ["corpus"]
CTE["vocab"] = """vocab AS (
  SELECT token, count(*) AS cnt FROM (SELECT unnest(tokens) AS token FROM ctok)
  GROUP BY token ORDER BY cnt DESC, token LIMIT 5000)"""
DEPS["vocab"] = ["ctok"]
CTE["dtok"] = f"dtok AS (SELECT doc_id AS id, text, {TOK.format('text')} AS tokens FROM documents)"
CTE["tf_c"] = """tf_c AS (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(tokens) AS term FROM ctok) t
  JOIN vocab v ON v.token = t.term GROUP BY id, term)"""
DEPS["tf_c"] = ["vocab"]
CTE["tf_d"] = """tf_d AS (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(tokens) AS term FROM dtok) t
  JOIN vocab v ON v.token = t.term GROUP BY id, term)"""
DEPS["tf_d"] = ["vocab", "dtok"]
CTE["weights"] = """weights AS (
  SELECT term, floor(16 * (p - n) / (p + n + 1)) / 16.0 AS weight FROM (
    SELECT term, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS n
    FROM tf_c JOIN corpus c USING (id) GROUP BY term))"""
DEPS["weights"] = ["tf_c"]
CTE["bow"] = """bow AS (
  SELECT id, CASE WHEN s > 0.5 THEN 'P' ELSE 'N' END AS pn,
         CASE WHEN s > 0.5 THEN round(s * 100, 2) ELSE round((1 - s) * 100, 2) END AS ratio
  FROM (SELECT d.id, 1.0 / (1.0 + exp(-(coalesce(z.z, 0.0) + 0.0))) AS s
        FROM dtok d LEFT JOIN (SELECT id, sum(tf * weight) AS z FROM tf_d JOIN weights USING (term) GROUP BY id) z
        ON z.id = d.id))"""
DEPS["bow"] = ["tf_d", "weights"]
SQL["tokenise"] = with_ctes(["dtok"], """
SELECT id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS tokens_text FROM dtok""")
SQL["vocab_top_k"] = with_ctes(["vocab"], "SELECT token, cnt FROM vocab")
SQL["term_frequency"] = with_ctes(["tf_c"], "SELECT id, term, tf FROM tf_c")
SQL["bow_score"] = with_ctes(["bow"], "SELECT id, pn, ratio FROM bow")
CTE["nag"] = f"""nag AS (
  SELECT word AS nag_word FROM (
    SELECT word, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS tox, sum(CASE WHEN toxic = 1 THEN 0 ELSE 1 END) AS clean
    FROM (SELECT DISTINCT d.doc_id, l.toxic, unnest({TOK.format('d.text')}) AS word
          FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
    GROUP BY word) WHERE tox >= 2 AND clean = 0)"""
SQL["keyword_override"] = with_ctes(["bow", "nag"], """
SELECT b.id, b.pn,
       CASE WHEN EXISTS (SELECT 1 FROM nag WHERE contains(d.text, nag.nag_word)) THEN 'N'
            WHEN b.pn = 'P' THEN 'P' ELSE 'C' END AS pn_final
FROM bow b JOIN dtok d ON d.id = b.id""")
CTE["lex"] = """lex AS (
  SELECT word, CAST(floor(40 * (p - n) / (p + n)) AS BIGINT) AS tenths FROM (
    SELECT word, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS n
    FROM (SELECT DISTINCT id, label, word FROM (SELECT id, label, unnest(tokens) AS word FROM ctok))
    GROUP BY word))"""
DEPS["lex"] = ["ctok"]
def lex_scores_sql(source: str, ids: str, text: str) -> str:
    """neg/neu/pos/compound per row of ``source`` (ids = comma list) from table lex."""
    return f"""
SELECT {ids},
       CASE WHEN total > 0 THEN round(abs(neg / total), 3) ELSE 0.0 END AS neg,
       CASE WHEN total > 0 THEN round(abs(neu / total), 3) ELSE 0.0 END AS neu,
       CASE WHEN total > 0 THEN round(abs(pos / total), 3) ELSE 0.0 END AS pos,
       CASE WHEN s10 IS NULL OR s10 = 0 THEN 0.0
            ELSE round(greatest(-1.0, least(1.0, s / sqrt(s * s + 15.0))), 4) END AS compound
FROM (
  SELECT *, pos + abs(neg) + neu AS total FROM (
    SELECT {ids}, s10, coalesce(s10, 0) / 10.0 AS s, coalesce(pos10, 0) / 10.0 AS pos,
           coalesce(neg10, 0) / 10.0 AS neg, CAST(neu_n AS DOUBLE) AS neu
    FROM (
      SELECT {ids}, sum(t) AS s10, sum(CASE WHEN t > 0 THEN t + 10 END) AS pos10,
             sum(CASE WHEN t < 0 THEN t - 10 END) AS neg10, count(CASE WHEN t = 0 THEN 1 END) AS neu_n
      FROM (
        SELECT {ids}, CASE WHEN c.token IS NOT NULL THEN coalesce(l.tenths, 0) END AS t
        FROM (SELECT {ids}, unnest(CASE WHEN len(tk) = 0 THEN [NULL] ELSE tk END) AS token
              FROM (SELECT {ids}, {TOK.format(text)} AS tk FROM {source})) c
        LEFT JOIN lex l ON l.word = c.token)
      GROUP BY {ids})))"""


SQL["lexicon_sentiment"] = with_ctes(["lex"], lex_scores_sql("conversations", "conv_id, turn", "text"))
SQL["token_doc_cache"] = with_ctes(["ctok"], "SELECT id, label, array_to_string(tokens, ' ') AS tokens_text FROM ctok")

# --- page scans and valuation ------------------------------------------------
from ..sources.html import _element_pattern  # noqa: E402
from . import company_pages as CP  # noqa: E402


def unescape_sql(e: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        e = f"replace({e}, {_q(ent)}, {_q(ch)})"
    return e


def strip_tags_sql(e: str) -> str:
    return unescape_sql(f"regexp_replace({e}, '<[^>]*>', '', 'g')")


def _anchor_branch(slot: str) -> str:
    first_a = r"regexp_extract(e, '(?is)<a\b[^>]*>', 0)"
    pat = _q(r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)')""")
    has = _q(r"""(?is)\shref\s*=\s*["']""")
    val = (f"CASE WHEN regexp_matches({first_a}, {has}) THEN "
           f"regexp_extract({first_a}, {pat}, 1) || regexp_extract({first_a}, {pat}, 2) END")
    return f"""
  SELECT page_id, '{slot}' AS slot, unnest(range(len(v))) AS pos, unnest(v) AS value FROM (
    SELECT page_id, list_filter(list_transform(regexp_extract_all(html, {_q(_element_pattern(slot))}, 1),
                                               lambda e: {val}), lambda x: x IS NOT NULL) AS v
    FROM pages)"""


SQL["anchor_attr_scan"] = ("SELECT page_id, slot, pos, " + unescape_sql("value") + " AS value FROM ("
                           + " UNION ALL ".join(_anchor_branch(s) for s in ("dd", "dt", "li")) + ")")
SQL["class_text_scan"] = f"""
SELECT page_id, unnest(range(len(v))) AS pos, unnest(v) AS text FROM (
  SELECT page_id, list_transform(regexp_extract_all(html, {_q(_element_pattern('div', 'ad'))}, 1),
                                 lambda e: {strip_tags_sql('e')}) AS v FROM pages)"""
SQL["company_profile"] = f"""
SELECT page_id,
       coalesce({strip_tags_sql(f"regexp_extract_all(html, {_q(_element_pattern('h1'))}, 1)[1]")}, '-') AS headline,
       coalesce({strip_tags_sql(f"regexp_extract_all(html, {_q(_element_pattern('li'))}, 1)[1]")}, '-') AS summary
FROM pages"""
SQL["html_table_scan"] = " UNION ALL ".join(
    f"SELECT p_partkey AS page_id, CAST(0 AS BIGINT) AS table_no, CAST(0 AS BIGINT) AS row_no, "
    f"CAST({i} AS BIGINT) AS col_no, '{c}' AS header, CAST({c} AS VARCHAR) AS cell FROM part"
    for i, c in enumerate(CP.LISTING_COLS))
SQL["cell_lookup"] = ("SELECT p_partkey AS page_id, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in CP.LISTING_COLS[1:]) + ", CAST(p_size AS VARCHAR) AS size_by_index FROM part")
SQL["filing_index_pick"] = """
SELECT o_custkey AS page_id, 'https://www.sec.gov' || arg_min(link, o_orderkey) AS link
FROM (SELECT o_custkey, o_orderkey, o_orderpriority,
             '/Archives/ix?doc=/' || CAST(o_orderkey AS VARCHAR) || '.htm' AS link,
             3 + (CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END)
               + (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_cells
      FROM orders)
WHERE n_cells > 3 AND contains(o_orderpriority, 'URGENT')
GROUP BY o_custkey"""
SNAP_ABORT = "p_size % 11 = 0"
SNAP_ABORT2 = "(p_size % 11 = 0 OR p_partkey % 103 = 0)"
SQL["market_snapshot"] = f"""
SELECT printf('%06d', p_partkey) AS code,
       {CP.SNAPSHOT[1][1]} AS sise_52_price,
       {CP.SNAPSHOT[2][1]} AS sise_revenue_rate,
       CASE WHEN {SNAP_ABORT} THEN '-' ELSE format('{{:,}}', p_partkey * 1000 + p_size) END AS sise_siga_tot,
       CASE WHEN {SNAP_ABORT2} THEN '-' ELSE format('{{:,}}', p_partkey * 7) END AS sise_siga_tot2,
       CASE WHEN {SNAP_ABORT2} THEN '-' ELSE {CP.SNAPSHOT[6][1]} END AS sise_issue_stock_normal
FROM part"""
SQL["consensus"] = f"""
SELECT printf('%06d', p_partkey) AS code, {CP.CONSENSUS[0]} AS toja_discision,
       CASE WHEN p_size % 13 = 0 THEN '-' ELSE format('{{:,}}', CAST(floor(p_retailprice * 13) AS BIGINT)) END AS toja_prop_price,
       CASE WHEN p_size % 13 = 0 THEN '-' ELSE format('{{:,}}', p_size * 37) END AS toja_eps,
       CASE WHEN p_size % 13 = 0 THEN '-' ELSE CAST(CAST(p_size % 40 AS DOUBLE) / 4 AS VARCHAR) END AS toja_per,
       CASE WHEN p_size % 13 = 0 THEN '-' ELSE CAST(p_size % 10 AS VARCHAR) END AS toja_comp
FROM part"""
CTE["rate"] = f"""rate AS (
  SELECT coalesce(k_raw, 20.0) AS k, coalesce(CAST(k_raw AS VARCHAR), '-') AS shown FROM (
    SELECT max(CASE WHEN s_suppkey = 10 THEN TRY_CAST(trim({CP.RATE_CELL}) AS DOUBLE) END) AS k_raw FROM supplier))"""
SQL["required_return"] = with_ctes(["rate"], """
SELECT printf('%06d', p_partkey) AS code, rate.k AS k, rate.shown AS srim_revenue_rate FROM part, rate""")
CTE["fin"] = """fin AS (
  SELECT p_partkey, p_size,
         p_retailprice + (CASE WHEN p_partkey % 7 = 0 THEN 60 WHEN p_partkey % 3 = 0 THEN 70 ELSE 80 END) AS c4,
         CAST(p_size - p_partkey % 9 AS DOUBLE) + (CASE WHEN p_partkey % 4 = 0 THEN -0.5 ELSE 0.0 END) AS roa,
         CAST(p_size AS DOUBLE) + (0.0) AS roe
  FROM part)"""
SQL["last_valid_period"] = with_ctes(["fin"], """
SELECT p_partkey AS page_id, CAST(9 AS BIGINT) AS row_no, c4 AS last_value FROM fin
UNION ALL SELECT p_partkey, 16, roa FROM fin
UNION ALL SELECT p_partkey, 17, roe FROM fin""")
SRIM_BODY = """
SELECT code, shown AS srim_revenue_rate, format('{:,}', c4) AS srim_jibea,
       CAST(roa AS VARCHAR) AS srim_roa, CAST(roe AS VARCHAR) AS srim_roe,
       format('{:,}', value) AS srim_value,
       CASE WHEN issued IS NULL THEN '-' ELSE format('{:,}', shares) END AS srim_issue_stock,
       CASE WHEN issued IS NULL OR shares = 0 THEN '-' ELSE format('{:,}', CAST(trunc(fair) AS BIGINT)) END AS srim_prop_price,
       CASE WHEN issued IS NULL OR shares = 0 THEN '-'
            ELSE format('{:,}', CAST(trunc(CASE WHEN over < 0 THEN fair - (p10 - fair) ELSE p10 END) AS BIGINT)) END AS srim_10_price,
       CASE WHEN issued IS NULL OR shares = 0 THEN '-'
            ELSE format('{:,}', CAST(trunc(CASE WHEN over < 0 THEN fair - (p20 - fair) ELSE p20 END) AS BIGINT)) END AS srim_20_price
FROM (
  SELECT *, CASE WHEN shares <> 0 THEN value / shares END AS fair,
         CASE WHEN shares <> 0 THEN (c4 + over * (0.9 / (1.0 + k / 100 - 0.9))) * 100000000.0 / shares END AS p10,
         CASE WHEN shares <> 0 THEN (c4 + over * (0.8 / (1.0 + k / 100 - 0.8))) * 100000000.0 / shares END AS p20
  FROM (
    SELECT *, issued - treasury AS shares, c4 * (c5 - k) / 100 AS over,
           (c4 + c4 * (roe - k) / k) * 100000000.0 AS value
    FROM (
      SELECT printf('%06d', f.p_partkey) AS code, f.c4, f.roa, f.roe, r.k, r.shown,
             CASE WHEN f.roe - f.roa > 5 THEN f.roa ELSE f.roe END AS c5,
             CASE WHEN f.p_size % 11 = 0 OR f.p_partkey % 103 = 0 THEN NULL ELSE 1000000 + (f.p_partkey % 97) * 1000 END AS issued,
             CASE WHEN f.p_partkey % 101 = 0 THEN 1000000 + (f.p_partkey % 97) * 1000
                  WHEN f.p_partkey % 5 = 0 THEN 0 ELSE f.p_size * 100 END AS treasury
      FROM fin f, rate r)))"""
SQL["srim_valuation"] = with_ctes(["rate", "fin"], SRIM_BODY)

# --- whole jobs and sinks ----------------------------------------------------
from ..sources.files import BREAKS  # noqa: E402
from ..operators.store import ERROR_PATTERN as _ERR  # noqa: E402
from . import jobs as J  # noqa: E402
from . import adapters as A  # noqa: E402

CTE["kept_items"] = """kept_items AS (
  SELECT h.* FROM headlines h JOIN (
    SELECT run_date, arg_min(struct_pack(page_no := page_no, slot := slot),
                             struct_pack(a := page_no, b := slot)) AS k
    FROM lists GROUP BY run_date, titles) f
  ON h.run_date = f.run_date AND h.page_no = f.k.page_no AND h.slot = f.k.slot)"""
DEPS["kept_items"] = ["lists"]
CTE["fresh"] = f"""fresh AS (
  SELECT l.*, strftime(l.run_date, '%Y-%m-%d') AS date_ FROM (
    SELECT i.*, m.code, m.name, replace(i.title, '-', '') AS content
    FROM (SELECT *, regexp_replace(split_part(title, ',', 1), {_q(CLEAN_PATTERN)}, '', 'g') AS key
          FROM kept_items) i
    JOIN master_d m ON i.key = m.name) l
  WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.code_ = l.code AND s.date_ = strftime(l.run_date, '%Y-%m-%d')))"""
DEPS["fresh"] = ["kept_items", "master_d", "store"]
CTE["fbow"] = f"""fbow AS (
  SELECT id, CASE WHEN s > 0.5 THEN 'P' ELSE 'N' END AS pn,
         CASE WHEN s > 0.5 THEN round(s * 100, 2) ELSE round((1 - s) * 100, 2) END AS ratio
  FROM (SELECT f.id, 1.0 / (1.0 + exp(-(coalesce(z.z, 0.0) + 0.0))) AS s
        FROM (SELECT seq AS id, {TOK.format('content')} AS tokens FROM fresh) f
        LEFT JOIN (SELECT id, sum(tf * weight) AS z FROM (
                     SELECT id, term, count(*) AS tf FROM (
                       SELECT seq AS id, unnest({TOK.format('content')}) AS term FROM fresh) t
                     JOIN vocab v ON v.token = t.term GROUP BY id, term)
                   JOIN weights USING (term) GROUP BY id) z ON z.id = f.id))"""
DEPS["fbow"] = ["fresh", "vocab", "weights"]


def job_ko_sql(nlp: bool, replies: bool = False) -> str:
    names = ["fresh", "latest", "max_report"] + (["fbow", "nag"] if nlp else []) + (["replies"] if replies else [])
    if nlp:
        pn = ("CASE WHEN EXISTS (SELECT 1 FROM nag WHERE contains(f.content, nag.nag_word)) THEN 'N' "
              "WHEN b.pn = 'P' THEN 'P' ELSE 'C' END")
        ratio, gpt, join = "b.ratio", verdict_sql("f.content", "P"), "JOIN fbow b ON b.id = f.seq"
        if replies:
            gpt = verdict_sql("coalesce(rp.reply, f.content)", "P")
            join += " LEFT JOIN replies rp ON rp.seq = f.seq"
    else:
        pn, ratio, gpt, join = "''", "CAST(0.0 AS DOUBLE)", "''", ""
    return with_ctes(names, f"""
SELECT strftime(f.run_date, '%Y%m%d') || '1800' || f.code AS key_, f.date_, '18:00' AS time_,
       f.code AS code_, f.name AS name_, f.content AS content_, {pn} AS pn_, {ratio} AS ratio_,
       coalesce(q.close, 0) AS close_, coalesce(q.diff, 0) AS diff_, coalesce(q.open, 0) AS open_,
       coalesce(q.high, 0) AS high_, coalesce(q.low, 0) AS low_, coalesce(q.volume, 0) AS volume_,
       {gpt} AS gpt_pn_, coalesce(r.stored_report, '') AS report_
FROM fresh f {join} LEFT JOIN latest q ON q.code = f.code LEFT JOIN max_report r ON r.code_ = f.code""")


SQL["job_ko"] = job_ko_sql(True)
SQL["job_ko_light"] = job_ko_sql(False)
SQL["job_ko_replies"] = job_ko_sql(True, replies=True)
SQL["append_predictions"] = SQL["job_ko"]
_within = "SELECT CAST(run_date AS DATE) FROM (" + SQL["backfill_horizon_wide"][SQL["backfill_horizon_wide"].index("\nSELECT"):] + ")"
LOOK_BACK = f"""kept_items AS (
  SELECT h.* EXCLUDE (run_date), (SELECT max(run_date) FROM lists) AS run_date FROM headlines h JOIN (
    SELECT arg_min(struct_pack(run_date := run_date, page_no := page_no, slot := slot),
                   struct_pack(a := date_diff('day', run_date, DATE '2100-01-01'), b := page_no, c := slot)) AS k
    FROM lists WHERE run_date IN ({_within}) GROUP BY titles) f
  ON h.run_date = f.k.run_date AND h.page_no = f.k.page_no AND h.slot = f.k.slot)"""
SQL["job_ko_backfill"] = SQL["job_ko"].replace(CTE["kept_items"], LOOK_BACK)

# details: market snapshot, consensus, S-RIM per code, joined to the light fact
CTE["snap"] = "snap AS (" + SQL["market_snapshot"] + ")"
CTE["cons"] = "cons AS (" + SQL["consensus"] + ")"
CTE["srimv"] = "srimv AS (" + SRIM_BODY + ")"
DEPS["srimv"] = ["rate", "fin"]
# every 17th company's page is filed under another code, so its articles have none
CTE["paged"] = """paged AS (
  SELECT printf('%06d', p_partkey) AS code, * FROM part WHERE p_partkey % 17 <> 0)"""
CTE["light"] = "light AS (" + job_ko_sql(False).replace("WITH ", "", 1).split("\nSELECT strftime(f.run_date", 1)[0] + ")"
_detail_fields = [c for c in J.DETAIL_COLUMNS if c not in ("key_", "date_", "code_")]
_src = {"ticker_desc1": "CASE WHEN p.p_partkey % 9 = 0 THEN '-' ELSE p.p_type END",
        "ticker_desc2": "CASE WHEN p.p_partkey % 9 = 0 THEN '-' ELSE p.p_brand END"}
SQL["ko_details"] = with_ctes(["fresh", "snap", "cons", "srimv", "rate", "paged"], f"""
SELECT strftime(f.run_date, '%Y%m%d') || f.code AS key_, strftime(f.run_date, '%Y%m%d') AS date_, f.code AS code_,
       {", ".join(f"coalesce({_src.get(c, c)}, {'rate.shown' if c == 'srim_revenue_rate' else _q('-')}) AS {c}" for c in _detail_fields)}
FROM fresh f CROSS JOIN rate
LEFT JOIN paged p ON p.code = f.code
LEFT JOIN snap ON snap.code = p.code LEFT JOIN cons ON cons.code = p.code LEFT JOIN srimv ON srimv.code = p.code""")
SQL["append_details"] = SQL["ko_details"]

_SYM = ("(CASE WHEN {k} % 7 = 0 THEN 'TX' || CAST({k} AS VARCHAR) "
        "ELSE 'T' || CAST({k} % 1000 AS VARCHAR) END)")
CTE["ustore"] = f"""ustore AS (
  SELECT {_SYM.format(k='o_custkey')} AS ticker, strftime(o_orderdate, '%Y%m%d') AS date_,
         CASE o_orderkey % 4 WHEN 0 THEN 'summary ' || CAST(o_orderkey AS VARCHAR)
              WHEN 1 THEN {_q(A.FAILURE_TEXT)} WHEN 2 THEN 'Error ' || CAST(o_orderkey AS VARCHAR) END AS report_
  FROM orders WHERE o_orderpriority = '1-URGENT')"""
CTE["uarts"] = f"""uarts AS (
  SELECT * FROM (
    SELECT *, regexp_extract(headline, '\\(([^)]*)', 1) AS ticker, strftime(run_date, '%Y%m%d') AS date_
    FROM (SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS run_date,
                 'Order ' || CAST(o_orderkey AS VARCHAR) || ' update'
                 || (CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' (' || {_SYM.format(k='o_custkey')} || ')' END)
                 || ' ' || o_orderpriority AS headline
          FROM orders)
    WHERE strpos(headline, '(') > 0) t
  WHERE length(ticker) <= 4
    AND NOT EXISTS (SELECT 1 FROM ustore s WHERE s.ticker = t.ticker AND s.date_ = t.date_))"""
DEPS["uarts"] = ["ustore"]
_norm = f"regexp_replace(replace(text, chr(10), ' '), {_q(WSR)}, ' ', 'g')"
_prefix = J.FILING_PROMPT.split("{company}")
SQL["filing_digest_requests"] = f"""
SELECT doc_id, CASE WHEN sec IS NOT NULL THEN {_q(_prefix[0])} || source || {_q(_prefix[1])} || body END AS prompt
FROM (
  SELECT doc_id, source, sec,
         CASE WHEN len(w) <= {J.FILING_WORDS} THEN kept ELSE array_to_string(w[1:{J.FILING_WORDS}], ' ') || '...' END AS body
  FROM (
    SELECT doc_id, source, sec, kept, list_filter(regexp_split_to_array(kept, {_q(WSR)}), lambda x: x <> '') AS w
    FROM (
      SELECT doc_id, source, sec, regexp_replace(sec, {_q(f'[^{HANGUL_KEEP}{WS}]+')}, '', 'g') AS kept
      FROM (SELECT doc_id, source, CASE WHEN strpos({_norm}, '. ') > 0 THEN split_part({_norm}, '. ', 2) END AS sec
            FROM documents))))"""
SQL["purge_error_reports"] = with_ctes(["store_all"], f"""
SELECT seq, code_, date_, report_ FROM store_all WHERE NOT coalesce(regexp_matches(report_, {_q(_ERR)}), false)""")
SQL["table_scan"] = with_ctes(["store_all"], "SELECT seq, code_, report_ FROM store_all WHERE date_ >= '2024-01-15'")
SQL["tsv_corpus_scan"] = f"""
SELECT CAST(d.doc_id AS VARCHAR) AS id, regexp_replace(d.text, {_q(BREAKS)}, ' ', 'g') AS document,
       CAST(l.quality AS VARCHAR) AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
SQL["target_list_scan"] = """
SELECT 'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_acctbal AS price, c_acctbal * 1.1 AS target_price FROM customer"""

# --- streaming, enrichment, request tables ------------------------------------
from ..operators import enrich as EN  # noqa: E402

SQL["incremental_headlines"] = with_ctes(["linked"], """
SELECT seq, strftime(run_date, '%Y-%m-%d') AS run_date, code, name, content FROM linked""")
SQL["batch_enrich"] = with_ctes(["headlines"], r"""
SELECT seq, CASE WHEN regexp_matches(title, '[^\x{00}-\x{7f}]') THEN title ELSE upper(title) END AS translated
FROM headlines""")

SQL["cached_enrich"] = SQL["batch_enrich"]


def _first_text_sql(tag, cls=None):
    return f"coalesce({strip_tags_sql(f'regexp_extract_all(html, {_q(_element_pattern(tag, cls))}, 1)[1]')}, 'None')"


_st = EN.SUMMARY_TEMPLATE
SQL["build_prompts"] = with_ctes(["headlines"], f"""
SELECT 'headline' AS src, seq AS id, replace(title, '-', '') || {_q(EN.KO_QUESTION_SUFFIX)} AS prompt FROM headlines
UNION ALL
SELECT 'page', page_id, replace({_q(_st.split('{name}')[0])} || {_first_text_sql('h1')}
       || {_q(_st.split('{name}')[1].split('{overview}')[0])} || {_first_text_sql('li')}
       || {_q(_st.split('{overview}')[1].split('{status}')[0])} || {_first_text_sql('div', 'ad')},
       {_q(EN.SUMMARY_DROP)}, '') FROM pages""")

# --- A7 modifier layer (exact oracle) ---------------------------------------
from ..operators import sentiment as _S  # noqa: E402


def _inlist(words) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


def _caps(e: str) -> str:
    return f"({e} = upper({e}) AND {e} <> lower({e}))"


def _boost(d: int) -> str:
    p = f"toks[i - {d} + 1]"
    step = (f"(CASE WHEN lower({p}) IN {_inlist(_S.BOOSTERS_UP)} THEN {_S.B_INCR} "
            f"WHEN lower({p}) IN {_inlist(_S.BOOSTERS_DOWN)} THEN {_S.B_DECR} ELSE 0.0 END)")
    adj = (f"(CASE WHEN {step} <> 0 AND {_caps(p)} AND capdiff THEN "
           f"(CASE WHEN {step} > 0 THEN {step} + {_S.C_INCR} ELSE {step} - {_S.C_INCR} END) ELSE {step} END)")
    return f"(CASE WHEN i >= {d} THEN {adj} * {_S.DAMP[d - 1]} ELSE 0.0 END)"


def _neg(d: int) -> str:
    return f"(CASE WHEN i >= {d} AND lower(toks[i - {d} + 1]) IN {_inlist(_S.NEGATIONS)} THEN 1 ELSE 0 END)"


_booster_words = _inlist(tuple(_S.BOOSTERS_UP) + tuple(_S.BOOSTERS_DOWN))
def lex_modified_sql(source: str, ids: str, text: str) -> str:
    """CTEs from t1 to m and the select of the modifier layer over a source's texts."""
    # twice, since matches that share a letter don't overlap
    word = "'(\\p{L})[''\u2019](\\p{L})', '\\1\\2', 'g'"
    joined = f"regexp_replace(regexp_replace({text}, {word}), {word})"
    return f"""t1 AS (
  SELECT {ids}, regexp_extract_all({joined}, '\\p{{L}}+') AS toks,
         length({text}) - length(replace({text}, '!', '')) AS n_excl,
         length({text}) - length(replace({text}, '?', '')) AS n_qm
  FROM {source}),
t2 AS (
  SELECT *, len(list_filter(toks, lambda t: {_caps('t')})) AS n_caps,
         coalesce(list_position(list_transform(toks, lambda t: lower(t)), 'but'), 0) AS but_at
  FROM t1),
t3 AS (SELECT *, n_caps > 0 AND n_caps < len(toks) AS capdiff FROM t2),
tk AS (
  SELECT {ids}, n_excl, n_qm, toks, capdiff, but_at,
         unnest(CASE WHEN len(toks) = 0 THEN [NULL] ELSE toks END) AS tok,
         unnest(CASE WHEN len(toks) = 0 THEN [NULL] ELSE range(len(toks)) END) AS i
  FROM t3),
ft AS (
  SELECT {ids}, n_excl, n_qm, tok, lower(tok) AS token,
         lower(tok) IN {_booster_words} AS is_booster,
         {_caps('tok')} AND capdiff AS caps,
         {_boost(1)} + {_boost(2)} + {_boost(3)} AS boost,
         {_neg(1)} + {_neg(2)} + {_neg(3)} AS negs,
         CASE WHEN but_at = 0 THEN 1.0 WHEN i + 1 < but_at THEN {_S.BUT_BEFORE}
              WHEN i + 1 > but_at THEN {_S.BUT_AFTER} ELSE 1.0 END AS but
  FROM tk),
vb AS (
  SELECT ft.*, CASE WHEN is_booster THEN 0.0 ELSE coalesce(l.tenths / 10.0, 0.0) END AS b
  FROM ft LEFT JOIN lex l ON l.word = ft.token),
v1 AS (SELECT *, CASE WHEN b = 0 THEN 0.0 ELSE b + (CASE WHEN caps THEN (CASE WHEN b > 0 THEN {_S.C_INCR} ELSE -{_S.C_INCR} END) ELSE 0.0 END) END AS va FROM vb),
v2 AS (SELECT *, CASE WHEN va = 0 THEN va ELSE va + (CASE WHEN va > 0 THEN boost ELSE -boost END) END AS vbst FROM v1),
v3 AS (SELECT *, CASE WHEN tok IS NOT NULL THEN vbst * pow({_S.N_SCALAR}, negs) * but END AS v FROM v2),
g AS (
  SELECT {ids}, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 END) AS pos_sum,
         sum(CASE WHEN v < 0 THEN v - 1 END) AS neg_sum, count(CASE WHEN v = 0 THEN 1 END) AS neu_n,
         first(n_excl) AS n_excl, first(n_qm) AS n_qm
  FROM v3 GROUP BY {ids}),
h AS (
  SELECT *, least(n_excl, {_S.EXCL_MAX}) * {_S.EXCL_STEP}
            + (CASE WHEN n_qm > {_S.QM_MAX_SMALL} THEN {_S.QM_BIG} WHEN n_qm > 1 THEN n_qm * {_S.QM_STEP} ELSE 0.0 END) AS punct,
         coalesce(s, 0.0) AS s0, coalesce(pos_sum, 0.0) AS p0, coalesce(neg_sum, 0.0) AS n0
  FROM g),
k AS (
  SELECT *, CASE WHEN s0 > 0 THEN s0 + punct WHEN s0 < 0 THEN s0 - punct ELSE s0 END AS sa,
         CASE WHEN p0 > abs(n0) THEN p0 + punct ELSE p0 END AS p2,
         CASE WHEN p0 < abs(n0) THEN n0 - punct ELSE n0 END AS n2,
         CAST(neu_n AS DOUBLE) AS neu
  FROM h),
m AS (SELECT *, p2 + abs(n2) + neu AS total FROM k)
SELECT {ids},
       CASE WHEN total > 0 THEN round(abs(n2 / total), 3) ELSE 0.0 END AS neg,
       CASE WHEN total > 0 THEN round(abs(neu / total), 3) ELSE 0.0 END AS neu,
       CASE WHEN total > 0 THEN round(abs(p2 / total), 3) ELSE 0.0 END AS pos,
       CASE WHEN sa = 0 THEN 0.0 ELSE round(greatest(-1.0, least(1.0, sa / sqrt(sa * sa + 15.0))), 4) END AS compound
FROM m"""


def _after_ctes(names: list[str], body: str) -> str:
    return with_ctes(names, ",\n" + body).replace("\n,\n", ",\n", 1)


SQL["lexicon_sentiment_modified"] = _after_ctes(["lex"], lex_modified_sql("conversations", "conv_id, turn", "text"))
_us_ctes, _us_select = lex_modified_sql("uarts", "seq", "headline").rsplit("\nSELECT ", 1)
_US_NAMED = """(SELECT 'T' || CAST(c_custkey % 1000 AS VARCHAR) AS ticker, min(c_name) AS company_name
      FROM customer GROUP BY 1) n"""
_US_STORED = f"""(SELECT ticker, max(report_) AS rep FROM ustore
           WHERE report_ NOT LIKE {_q('%' + FAILURE_MARK + '%')} GROUP BY ticker) r"""
SQL["job_us"] = _after_ctes(["uarts", "lex"], f"""{_us_ctes},
uscores AS (SELECT {_us_select})
SELECT a.ticker, a.date_, '1800' AS time_, a.headline, n.company_name,
       coalesce(r.rep, '') AS report_, sc.neg, sc.neu, sc.pos, sc.compound
FROM uarts a JOIN {_US_NAMED} ON n.ticker = a.ticker LEFT JOIN {_US_STORED} ON r.ticker = a.ticker
JOIN uscores sc ON sc.seq = a.seq""")
SQL["append_us"] = SQL["job_us"]
SQL["job_us_stored"] = f"SELECT * FROM ({SQL['job_us']}) WHERE NOT regexp_matches(report_, 'Error|에러')"
SQL["report_requests"] = with_ctes(["uarts"], f"""
SELECT a.seq, a.ticker, '다음 문장은 나스닥 상장사 ' || n.company_name || '의 오늘 뉴스 타이틀 입니다. ' || a.headline
       || '. 이 회사의 간단한 소개 및 현재 상황을 문장 기호를 사용하여 5문장 이내로 알려 주세요. (물론입니다.는 생략 해 주세요)' AS prompt
FROM uarts a JOIN {_US_NAMED} ON n.ticker = a.ticker LEFT JOIN {_US_STORED} ON r.ticker = a.ticker
WHERE coalesce(r.rep, '') = ''""")
SQL["bow_train_scores"] = "SELECT doc_id AS id, true AS valid FROM documents"

SQL["job_ko_stored"] = ("SELECT * FROM (" + SQL["job_ko"] + f") j WHERE NOT coalesce(regexp_matches(report_, {_q(_ERR)}), false)")

SQL["filing_doc_pick"] = """
SELECT page_id, replace('https://www.sec.gov' || first_row.link, 'ix?doc=/', '') AS link
FROM (
  SELECT o_custkey AS page_id, arg_min(struct_pack(link := link), o_orderkey) AS first_row
  FROM (SELECT o_custkey, o_orderkey, o_orderpriority,
               CASE WHEN o_orderstatus <> 'P'
                    THEN '/ix?doc=/Archives/' || CAST(o_orderkey AS VARCHAR) || '.htm' END AS link,
               2 + (CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS n_cells
        FROM orders)
  WHERE n_cells > 1 AND contains(o_orderpriority, 'URGENT')
  GROUP BY o_custkey)"""
SQL["stock_master"] = with_ctes(["master"], "SELECT name, code FROM master")

# --- P16 without look-behind: test every position, then cut ------------------
_W = r"[\p{L}\p{Mn}\p{Mc}\p{Me}\p{Nd}\p{Pc}]"
_ch = "substr(text, {}, 1)"
_split_at = (f"regexp_matches({_ch.format('i')}, {_q('[' + WS + ']')}) AND i >= 2 "
             f"AND {_ch.format('i - 1')} IN ('.', '?') "
             f"AND NOT (i >= 5 AND regexp_matches({_ch.format('i - 4')}, {_q(_W)}) AND {_ch.format('i - 3')} = '.' "
             f"AND regexp_matches({_ch.format('i - 2')}, {_q(_W)}) AND {_ch.format('i - 1')} <> chr(10)) "
             f"AND NOT (i >= 4 AND regexp_matches({_ch.format('i - 3')}, '[A-Z]') "
             f"AND regexp_matches({_ch.format('i - 2')}, '[a-z]') AND {_ch.format('i - 1')} = '.')")
SQL["sentences_split"] = f"""
SELECT conv_id, turn, CAST(k - 1 AS BIGINT) AS pos,
       substr(text, CASE WHEN k = 1 THEN 1 ELSE cuts[k - 1] + 1 END,
              (CASE WHEN k = len(cuts) + 1 THEN length(text) + 1 ELSE cuts[k] END)
              - (CASE WHEN k = 1 THEN 1 ELSE cuts[k - 1] + 1 END)) AS sentence
FROM (
  SELECT conv_id, turn, text, cuts, unnest(range(1, len(cuts) + 2)) AS k
  FROM (SELECT conv_id, turn, text,
               list_filter(range(1, length(text) + 1), lambda i: {_split_at}) AS cuts
        FROM conversations))"""

SQL["format_floats"] = """
SELECT l_extendedprice, l_tax, format('{:,}', l_extendedprice * (1 + l_tax) * 1000) AS value_text,
       format('{:,}', -l_discount) AS discount_text
FROM lineitem"""

SQL["report_requests_ko"] = with_ctes(["fresh", "max_report", "paged"], f"""
SELECT f.code, f.name, replace(replace(replace(replace({_q(EN.SUMMARY_TEMPLATE)}, '{{name}}', f.name),
         '{{overview}}', {CP.SUMMARY_ITEM.replace('STRING', 'VARCHAR')}),
         '{{status}}', CASE WHEN p_partkey % 5 = 0 THEN 'None' ELSE {CP.SUMMARY_STATUS} END), {_q(EN.SUMMARY_DROP)}, '') AS prompt
FROM (SELECT DISTINCT f.code, f.name FROM fresh f LEFT JOIN max_report r ON r.code_ = f.code WHERE coalesce(r.stored_report, '') = '') f
JOIN paged p ON p.code = f.code WHERE p_partkey % 8 <> 0""")

SQL["format_floats_wide"] = """
SELECT l_orderkey, l_linenumber, format('{:,}', CAST(CAST(l_partkey AS VARCHAR) || '.' || CAST(l_suppkey AS VARCHAR) || '7e'
       || CAST(l_orderkey % 620 - 320 AS VARCHAR) AS DOUBLE)) AS value_text
FROM lineitem"""

SQL["corpus_quarantine"] = """
SELECT label || ': ' || CAST(count(*) AS VARCHAR) AS line, 'good' AS reason, 'good' AS folder
FROM (SELECT CAST(l.quality AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id) GROUP BY label
UNION ALL
SELECT CASE doc_id % 5 WHEN 0 THEN doc_id || chr(9) || 'only' WHEN 1 THEN doc_id || chr(9) || 'a' || chr(9) || '1' || chr(9) || 'b'
            WHEN 2 THEN doc_id || chr(9) || 'a' || chr(9) || '7' WHEN 3 THEN ' ' || chr(9) || 'a' || chr(9) || '1'
            ELSE doc_id || chr(9) || 'a' || chr(65533) || chr(9) || '1' END,
       ['fields', 'fields', 'label', 'id', 'encoding'][doc_id % 5 + 1], 'broken'
FROM documents"""
SQL["target_quarantine"] = """
SELECT 'T, ' || c_custkey || ' ' || c_custkey AS line, 'good' AS reason, 'good' AS folder FROM customer
UNION ALL
SELECT CASE c_custkey % 4 WHEN 0 THEN 'T' || c_custkey || ',1.0' WHEN 1 THEN 'T' || c_custkey || ',1.0,2.0,3.0'
            WHEN 2 THEN ',' || c_custkey || ',2.0' ELSE 'T' || c_custkey || ',one,2.0' END,
       ['fields', 'fields', 'ticker', 'number'][c_custkey % 4 + 1], 'broken'
FROM customer"""

SQL["bow_score_stored"] = SQL["bow_score"]
SQL["bow_loss"] = with_ctes(["tf_c", "weights"], """
SELECT count(*) AS n, round(avg(greatest(z, 0) - z * label + ln(1 + exp(-abs(z)))), 6) AS loss
FROM (SELECT coalesce(z, 0.0) AS z, CAST(label AS DOUBLE) AS label
      FROM corpus c LEFT JOIN (SELECT id, sum(tf * weight) AS z FROM tf_c JOIN weights USING (term) GROUP BY id) s ON s.id = c.id)""")

_shown = " || ".join(f"{_q(text)} || '=' || {_q(label)} || chr(10)" for text, label in EN.EXAMPLES)
SQL["build_text_prompts"] = with_ctes(["headlines"], f"""
SELECT 'text' AS src, doc_id AS id, {_q(EN.TEXT_SUMMARY)} || text AS prompt FROM documents WHERE text IS NOT NULL
UNION ALL
SELECT 'report', doc_id, {_q(EN.REPORT_SUMMARY)} || text FROM documents WHERE text IS NOT NULL
UNION ALL
SELECT 'headline', seq, chr(10) || {_shown} || title || '=' || chr(10) FROM headlines""")

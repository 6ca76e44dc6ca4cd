"""Registered queries of this subpackage, each over its whole tables, and their SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.llm import audit, decontam, langid, license_rules, licenses, lines, mixing, neardup, pii, substrings, token_store, topk, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digests(table(spark, sf_dir, "documents"), spell_control=True)  # the library's plain call


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return topk.exact_topk(vectors, F.pmod(F.col("vec_id"), F.lit(50)) == 0, 5)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.record_digests(table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated(table(spark, sf_dir, "documents")).drop("removed_from", "removed_to")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over web pages, with the markup, address and host evidence they have."""
    model = langid.fit(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return langid.identify_pages(table(spark, sf_dir, "pages"), model)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_binary": op1_token_binary,
    "op2_exact_topk": op2_exact_topk,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language_id": op7_language_id,
    "language_id_pages": language_id_pages,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_license_scan": op13_license_scan,
}


def license_sql() -> str:
    """Rules and hits as tables; base phrases by comparing slices of the words."""
    rows = ", ".join(f"({r.number}, '{r.label}', '{k}', '{r.regex}', {r.priority}, {r.score})" for r in license_rules.rules() for k in r.keys)
    base = ", ".join(f"(string_split('{phrase}', ' '), '{label}')" for phrase, _, label in licenses.BASE)
    return rf"""
        WITH rules(rule, label, key, regex, priority, score) AS (VALUES {rows}),
        base(phrase, label) AS (VALUES {base}),
        d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORD}') AS w
          FROM documents),
        p AS (SELECT r, w, w[i] AS word, i FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
        places AS (
          SELECT r, i - 1 AS place, label FROM p JOIN base ON p.word = phrase[1] AND list_slice(w, i, i + len(phrase) - 1) = phrase),
        b AS (SELECT r, count(*) AS n, min(place) AS f, max(place) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
        tried AS (
          SELECT r, rule, label, priority, score, i AS start, regexp_extract(array_to_string(list_slice(w, i, i + {license_rules.WINDOW - 1}), ' ') || ' ', regex) AS m
          FROM p JOIN rules ON word = key),
        hits AS (SELECT *, start + length(m) - length(replace(m, ' ', '')) AS stop FROM tried WHERE m <> ''),
        kept AS (
          SELECT * FROM hits AS h WHERE NOT EXISTS (
            SELECT 1 FROM hits AS o WHERE o.r = h.r AND o.start <= h.start AND o.stop >= h.stop
              AND (o.priority, h.stop - h.start, o.rule) < (h.priority, o.stop - o.start, h.rule))),
        k AS (SELECT r, max(score) AS score FROM kept GROUP BY r),
        every AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM kept UNION ALL SELECT r, label FROM places) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.f AS BIGINT) AS first_word,
               CAST(b.l AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
               CAST(greatest(coalesce(k.score, 0), CASE WHEN b.n > 0 THEN {licenses.BASE_SCORE} ELSE 0 END) AS DOUBLE) AS score
        FROM d LEFT JOIN b USING (r) LEFT JOIN every USING (r) LEFT JOIN k USING (r)"""


SQL: dict[str, str] = {
    "op2_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op4_line_dedup": r"""
        WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
        w AS (SELECT doc_id, i, array_to_string(list_slice(a, i, i + 2), chr(10)) AS t
              FROM l, unnest(range(1, len(a) - 1)) AS u(i)),
        later AS (
          SELECT doc_id, i FROM w WHERE regexp_matches(t, '[^\x20\x09-\x0D]')
          QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1),
        gone AS (
          SELECT doc_id, list(DISTINCT i + d) AS g FROM later, (VALUES (0), (1), (2)) AS x(d) GROUP BY doc_id)
        SELECT doc_id, CAST(len(a) AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(list_filter(a, lambda x, i: g IS NULL OR NOT list_contains(g, i)), chr(10))) AS kept_sha256
        FROM l LEFT JOIN gone USING (doc_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
        FROM f""",
    "op8_decontamination": r"""
        WITH dw AS (
          SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
        bw AS (
          SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        win AS (
          SELECT DISTINCT item_id, least(13, len(w)) AS n,
                 array_to_string(list_slice(w, s, s + least(13, len(w)) - 1), ' ') AS k
          FROM bw, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(s) WHERE len(w) > 0),
        occ AS (
          SELECT DISTINCT d.doc_id, d.s, d.n, win.item_id
          FROM (SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k
                FROM dw, (SELECT DISTINCT n FROM win) AS l, unnest(range(1, len(w) - n + 2)) AS u(s)) AS d
          JOIN win ON win.n = d.n AND win.k = d.k),
        hit AS (
          SELECT doc_id, count(DISTINCT p) AS n_hit FROM occ, unnest(range(s, s + n)) AS u(p) GROUP BY doc_id),
        items AS (
          SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
        SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_filter_audit": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        m AS (
          SELECT doc_id, part,
                 (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
                 + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END)
                 + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
                 + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS fails FROM d),
        l AS (
          SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        c AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
          FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
        o AS (
          SELECT '' AS prefix, 0 AS before, '' AS letter, 0 AS bit, 0 AS step
          UNION ALL
          SELECT prefix || l2.letter, before + o.bit, l2.letter, l2.bit, step + 1
          FROM o JOIN letters AS l2 ON (before + o.bit) & l2.bit = 0 AND step < 5),
        s AS (
          SELECT f.prefix AS filter_order, p.step, p.letter, p.bit, p.before
          FROM o AS f JOIN o AS p ON f.step = 5 AND p.step > 0 AND starts_with(f.prefix, p.prefix)),
        r AS (
          SELECT part, filter_order, step, letter,
                 coalesce(sum(n) FILTER (WHERE fails & (before + bit) = 0), 0) AS kept,
                 coalesce(sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before = 0), 0) AS removed,
                 coalesce(sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before <> 0), 0) AS redundant,
                 coalesce(sum(n) FILTER (WHERE fails = bit), 0) AS unique_fails,
                 coalesce(sum(good) FILTER (WHERE fails & bit <> 0 AND fails & before = 0), 0) AS good_lost,
                 coalesce(sum(toxic) FILTER (WHERE fails & bit <> 0 AND fails & before = 0), 0) AS toxic_lost
          FROM c, s GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM r""",
}
SQL["op13_license_scan"] = license_sql()

"""Operator 7: language identification by Bayesian evidence fusion.

For each text and language: log P(language | host) + log P(declared | language) + log P(address
suffix | language) + ``TEMPER`` times the text's log-likelihood.

* Text: byte trigrams around letters (ASCII lower-cased) of the whole text, hashed to ``BUCKETS``; the
  distributions are fitted on at most ``sample_rows`` labelled rows of each label, in ``STRATA``
  parts those with the smallest hashed ids (a documented bound), so every label has one. A share
  ``EVEN`` of each is spread over all buckets, however large its sample; the class ``und`` spreads
  evenly over all buckets, less ``UND_PENALTY``.
* A first pass over all rows takes the likeliest language of each text alone. Grouped counts
  of it give the priors of a host, smoothed towards its domain's, which are smoothed towards
  those of the whole corpus, and the probabilities of each declared language and address suffix.
  A row's own count is taken out of its host's and domain's, so its text counts once.

A row is rejected if its language is ``und``: no letters, or unlike every language fitted
though its declared language, if any, is one of them.

Cases: null, empty or letterless text is ``und``; a text too short for a trigram is judged by
the other evidence alone; evidence that is null or unknown
counts for nothing; rows that repeat an id are rows of their own; without labelled rows every
language is ``und`` and nothing is rejected; an empty label and ``und`` name no language; an empty table gives no rows; other columns are ignored by
``identify`` and kept by ``keep_identified``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.llm.tables import fresh, lean, stored
from tickerlens.session import ensure_shipped

BUCKETS = 1 << 15
TEMPER = 0.3
EVEN = 0.01
SMOOTH_HOST = 5.0
SMOOTH_EVIDENCE = 1.0
SAMPLE_ROWS = 4000  # of each label
STRATA = 8  # parts by hashed id in which a label's rows are ranked
PIECE = 1 << 20  # a text is counted in pieces of this many bytes
UND = "und"
UND_PENALTY = 1.5  # nats a trigram by which ``und`` must beat every language: doubtful texts stay
# letters lower-cased, bytes beyond ASCII as they are, all else (digits, marks, white space) a space
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def trigram_buckets(text: bytes) -> Iterator[np.ndarray]:
    """Bucket of every byte trigram around a letter, in pieces. Numbers, marks and codes made
    of digits say nothing of a language, so they don't count."""
    data = np.frombuffer(text.translate(_LETTERS), dtype=np.uint8)
    for i in range(0, max(0, len(data) - 2), PIECE):
        b = data[i:i + PIECE + 2].astype(np.uint32)
        code = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:])[b[1:-1] != 32]
        yield (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


class TextModel:
    """log P(trigram bucket | language), the last row for ``und``."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages = [*languages, UND]
        even = np.full((1, BUCKETS), -np.log(BUCKETS) - UND_PENALTY, dtype=np.float32)
        self.logs = np.concatenate([logs, even])

    def score(self, text: bytes) -> np.ndarray:
        """Log-likelihood per language; texts without letters are left to ``und``."""
        out = np.zeros(len(self.languages))
        for at in trigram_buckets(text):
            counts = np.bincount(at, minlength=BUCKETS) if len(at) > BUCKETS else None
            if counts is not None:
                out += self.logs @ counts.astype(np.float32)
            else:
                out += self.logs[:, at].sum(axis=1, dtype=np.float64)
        if not has_letters(text):
            out[:-1] -= 1e6
        return out


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xF5)]] = True


def has_letters(text: bytes) -> bool:
    return any(_LETTER[np.frombuffer(text[i:i + 4096], dtype=np.uint8)].any() for i in range(0, len(text), 4096))


def log_shares(counts: np.ndarray) -> np.ndarray:
    """log P(bucket): the shares of the counts but for ``EVEN``, which all buckets share."""
    return np.log((1 - EVEN) * counts / max(1, counts.sum()) + EVEN / BUCKETS).astype(np.float32)


def fit(labelled: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Distributions of every label, each from at most ``sample_rows`` of its rows."""
    ensure_shipped(labelled.sparkSession)
    order = F.xxhash64(F.lit(42), F.col(id_col))
    rows = (labelled.where(F.col(text_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), order.alias("o"), F.col(text_col).cast("string").alias("text"))
            .where((F.lower("label") != UND) & (F.trim("label") != "")).withColumn("part", F.pmod("o", F.lit(STRATA))))
    # the ids are drawn first; texts of the drawn rows alone are then counted
    ranked = Window.partitionBy("label", "part").orderBy("o")
    limits = stored(rows.select("label", "part", "o").withColumn("rank", F.row_number().over(ranked))
                    .where(F.col("rank") <= max(1, sample_rows // STRATA)).groupBy("label", "part").agg(F.max("o").alias("limit")), "langid-sample")
    sample = rows.join(limits, ["label", "part"]).where("o <= limit").select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for label, cell in zip(b.column(0).to_pylist(), b.column(1)):
                sums.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
                for at in trigram_buckets(cell.as_buffer().to_pybytes()):
                    sums[label] += np.bincount(at, minlength=BUCKETS)
        for label, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([label] * (len(at) + 1)), pa.array(np.append(at, 0)), pa.array(np.append(c[at], 0))],
                                             names=["label", "bucket", "n"])

    def shares(t: pa.Table) -> pa.Table:
        counts = np.zeros(BUCKETS)
        np.add.at(counts, t.column("bucket").to_numpy(), t.column("n").to_numpy())
        return pa.table({"label": t.column("label").slice(0, 1), "logs": pa.array([log_shares(counts).tobytes()], pa.binary())})

    sums = sample.mapInArrow(lean(count), "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # BUCKETS floats of each label
    models = stored(sums.groupBy("label").applyInArrow(shares, "label string, logs binary"), "langid-models").orderBy("label").collect()
    logs = [np.frombuffer(r["logs"], dtype=np.float32) for r in models]
    return TextModel([r["label"] for r in models], np.stack(logs) if logs else np.zeros((0, BUCKETS), np.float32))


def _text_scores(rows: DataFrame, model: TextModel, text_col: str, others: list[str]) -> DataFrame:
    """``others`` and the log-likelihoods and best language index of each row's text, and whether it has letters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # (languages + 1) x BUCKETS floats
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*others).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [cell.as_buffer().to_pybytes() if cell.is_valid else b"" for cell in b.column(len(others))]
            scores = [m.score(t) for t in texts]
            best = [int(np.argmax(s)) if s.any() else -1 for s in scores]  # too short a text has none
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(others))), pa.array(scores, pa.list_(pa.float64())),
                                              pa.array(best, pa.int32()), pa.array([has_letters(t) for t in texts])],
                                             names=[*others, "loglik", "best", "letters"])
    return rows.select(*others, F.col(text_col)).mapInArrow(lean(run), f"{schema}, loglik array<double>, best int, letters boolean")


def _counts(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """Per value of ``key``: how many rows have each language as their text's best."""
    each = [F.sum((F.col("best") == i).cast("double")) for i in range(n)]
    return stored(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*each).alias(name)), f"langid-{name}")


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def identify(rows: DataFrame, model: TextModel, *, id_col: str, text_col: str, host: Column | None = None,
             domain: Column | None = None, declared: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """(id, language, probability, text_language, rejected) of each row."""
    ensure_shipped(rows.sparkSession)
    n = len(model.languages)
    null = F.lit(None).cast("string")
    prepared = rows.select(F.col(id_col).cast("long").alias("id"), *[(c if c is not None else null).cast("string").alias(k) for k, c in
                           (("host", host), ("domain", domain), ("declared", declared), ("suffix", suffix))],
                           F.col(text_col).cast("string").alias("text"))
    seen = stored(_text_scores(prepared, model, "text", ["id", "host", "domain", "declared", "suffix"]), "langid-text")

    everyone = seen.groupBy("best").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    world = np.ones(n)
    for r in everyone:
        if r["best"] >= 0:
            world[r["best"]] += r["n"]
    of_all = F.array(*[F.lit(float(x)) for x in world])
    prior = F.array(*[F.lit(float(x)) for x in world / world.sum()])
    joined = seen
    for key in ("host", "domain", "declared", "suffix"):
        joined = joined.join(_counts(seen, key, n, f"by_{key}"), key, "left")
    zero = F.array(*[F.lit(0.0)] * n)
    own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == F.col("best")).cast("double"))

    def others(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.zip_with(F.col(name), "own", lambda a, b: a - b)).otherwise(zero)

    def smoothed(counts: str, parent: str) -> Column:
        return F.zip_with(F.col(counts), F.col(parent), lambda c, p: (c + SMOOTH_HOST * p) / (F.col(f"{counts}_n") + SMOOTH_HOST))

    def evidence(name: str, key: str) -> Column:
        """log P(value | language) from the counts of all rows; nothing if the value is null."""
        values = kinds[key]
        p = F.zip_with(F.col(name), of_all, lambda c, a: F.log((c + SMOOTH_EVIDENCE / values) / (a + SMOOTH_EVIDENCE)))
        return F.when(F.col(name).isNotNull(), p).otherwise(zero)

    kinds = {k: max(1, seen.select(k).distinct().count()) for k in ("declared", "suffix")}
    joined = joined.withColumn("own", own).withColumns({"in_domain": others("by_domain"), "in_host": others("by_host"), "prior": prior})
    joined = joined.withColumns({"in_domain_n": _total(F.col("in_domain")), "in_host_n": _total(F.col("in_host"))})
    joined = joined.withColumn("p_domain", smoothed("in_domain", "prior")).withColumn("p_host", smoothed("in_host", "p_domain"))
    joined = joined.withColumns({"e_declared": evidence("by_declared", "declared"), "e_suffix": evidence("by_suffix", "suffix")})
    score = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get("loglik", i) * F.lit(TEMPER) + F.log(F.get("p_host", i))
                        + F.get("e_declared", i) + F.get("e_suffix", i))
    joined = joined.withColumn("score", score).withColumn("top", F.array_max("score"))
    sure = 1 / _total(F.transform("score", lambda x: F.exp(x - F.col("top"))))
    names = F.array(*[F.lit(x) for x in model.languages])
    language = F.get(names, F.array_position("score", F.col("top")).cast("int") - 1)
    # what no model was fitted for cannot be judged unlike it
    unfitted = F.coalesce(~F.col("declared").isin("", *[x.lower() for x in model.languages]), F.lit(False))
    return joined.select("id", language.alias("language"), sure.alias("probability"), F.get(names, F.col("best")).alias("text_language"),
                         (F.lit(n > 1) & (language == UND) & ~(F.col("letters") & unfitted)).alias("rejected"))


def identify_documents(docs: DataFrame, model: TextModel | None = None, *, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "lang", host_col: str = "source") -> DataFrame:
    """Documents: the declared language is ``label_col``, the host is ``host_col``."""
    model = model or fit(docs, id_col, text_col, label_col)
    out = identify(docs, model, id_col=id_col, text_col=text_col, host=F.col(host_col), declared=F.lower(F.col(label_col).cast("string")))
    return out.withColumnRenamed("id", "doc_id")


def identify_pages(pages: DataFrame, model: TextModel, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Web pages: language of the html tag, host, domain and last label of the address."""
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    declared = F.lower(F.regexp_extract(F.col(html_col), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    shown = F.regexp_replace(F.col(html_col), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    rows = pages.select(F.col(id_col).alias("id_"), shown.alias("text_"), host.alias("host_"),
                        F.when(declared != "", declared).alias("declared_"), F.element_at(labels, -1).alias("suffix_"),
                        F.when(F.size(labels) > 1, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1))).alias("domain_"))
    out = identify(rows, model, id_col="id_", text_col="text_", host=F.col("host_"), domain=F.col("domain_"),
                   declared=F.col("declared_"), suffix=F.col("suffix_"))
    return out.withColumnRenamed("id", "page_id")


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns. Rows that share an
    id stay together unless all of them are rejected."""
    found = stored(identify_documents(docs, id_col=id_col, **kw), "langid-result")
    [id_] = fresh(docs, "gone")
    gone = found.groupBy("doc_id").agg(F.min("rejected").alias("all_")).where("all_").select(F.col("doc_id").alias(id_))
    gone = stored(gone, "langid-rejected")
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[id_]), "left_anti")

"""Operator 4: line deduplication by overlapping windows of three lines.

Each run of ``window`` consecutive lines of a text is hashed (128 bits). A window's first
occurrence, by document id and then line, stays; the lines that any later occurrence covers
are removed, overlapping covers merged. Windows are judged on the input, not on what is left.

Grouped counts with partial aggregation find the repeated windows and their first places, so
a window that a third of all documents share costs one small row per task. Documents are
shuffled only to cut their lines out; the windows travel as hashes.

Cases: lines are what stands between line breaks, so a null or empty text is one empty line;
texts of fewer lines have no window and stay; windows of white space alone don't count; a null
id comes first; of rows that repeat id and text the first is judged like any other and all
windows of the others are later occurrences; an empty table gives no rows; other columns are
ignored by ``removed_lines`` and kept by ``deduplicate``.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.llm.tables import fresh, stored
from tickerlens.session import ensure_shipped

WINDOW = 3
ROWS = "doc_id long, k binary, n_lines long, sha256 string, at array<long>, w1 array<long>, w2 array<long>"


def windows(text: bytes, window: int) -> tuple[int, list[int], np.ndarray]:
    """(number of lines, first line of each window that counts, its hash as two integers)."""
    parts = text.split(b"\n")
    at, digests = [], []
    for i in range(len(parts) - window + 1):
        w = b"\n".join(parts[i:i + window])
        if w.split():
            at.append(i)
            digests.append(xxhash.xxh3_128_digest(w))
    return len(parts), at, np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def _text(cell) -> bytes:
    return cell.as_buffer().to_pybytes() if cell.is_valid else b""


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def scan(plain: DataFrame, window: int) -> DataFrame:
    """The windows of each row; ``k`` is the text's digest, which with the id names the row."""
    ensure_shipped(plain.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, n, sha, ats, w1, w2 = [], [], [], [], [], []
            for cell in b.column(1):
                text = _text(cell)
                lines, at, h = windows(text, window)
                k.append(hashlib.md5(text, usedforsecurity=False).digest())
                n.append(lines)
                sha.append(hashlib.sha256(text).hexdigest())
                ats.append(at)
                w1.append(h[:, 0])
                w2.append(h[:, 1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(k, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string())]
                + [pa.array(x, pa.list_(pa.int64())) for x in (ats, w1, w2)], names=["doc_id", "k", "n_lines", "sha256", "at", "w1", "w2"])
    return plain.mapInArrow(run, ROWS)


def removed_lines(plain: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, gone) of (doc_id, text) rows: ``rows`` names the different rows with their number
    of copies; ``gone`` has the removed lines of each (``lines``) and of its further copies
    (``copy_lines``), of those that lose any."""
    found = stored(scan(plain, window), "lines-rows")
    rows = stored(found.groupBy("doc_id", "k").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n_lines", "sha256", "at", "w1", "w2")]),
                  "lines-distinct")
    each = rows.select("doc_id", "k", F.inline(F.arrays_zip("at", "w1", "w2")))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", "at")
    again = stored(each.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
                   .select("w1", "w2", "first"), "lines-repeated")
    later = each.join(again, ["w1", "w2"]).where(place != F.col("first")).select("doc_id", "k", "at")
    lines = later.groupBy("doc_id", "k").agg(F.collect_set("at").alias("later"))  # windows of one text
    lines = stored(lines, "lines-later").select(F.col("doc_id").alias("d"), F.col("k").alias("kk"), "later")

    def covered(starts: Column) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + (window - 1))))))

    same = rows["doc_id"].eqNullSafe(lines["d"]) & (rows["k"] == lines["kk"])
    gone = (rows.join(lines, same, "left").where(F.col("later").isNotNull() | ((F.col("copies") > 1) & (F.size("at") > 0)))
            .select("doc_id", "k", "copies", F.when(F.col("later").isNotNull(), covered(F.col("later"))).otherwise(F.expr("cast(array() as array<bigint>)")).alias("lines"),
                    F.when(F.col("copies") > 1, covered(F.col("at"))).alias("copy_lines")))
    return rows, stored(gone, "lines-gone")


def _cut(text: bytes, lines: list[int]) -> bytes:
    drop = set(lines)
    return b"\n".join(p for i, p in enumerate(text.split(b"\n")) if i not in drop)


def line_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of each row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, gone = removed_lines(plain, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sha = [hashlib.sha256(_cut(_text(cell), lines)).hexdigest() for cell, lines in zip(b.column(2), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(4), pa.array(sha, pa.string())], names=["doc_id", "k", "copy", "kept"])

    # the texts that lose lines, once for the first row and once for the further copies
    lost = stored(gone.select("doc_id", "k", F.inline(F.filter(F.array(
        F.struct(F.lit(False).alias("copy"), F.col("lines").alias("lines")), F.struct(F.lit(True).alias("copy"), F.col("copy_lines").alias("lines"))),
        lambda x: F.size(x["lines"]) > 0))), "lines-lost")
    texts = plain.where("text IS NOT NULL").withColumn("k_", _key(F.col("text"))).withColumnRenamed("doc_id", "d_")
    # the same plan at every size: both sides are dealt by the text's key
    met = texts.join(lost.hint("merge"), (F.col("k_") == F.col("k")) & F.col("d_").eqNullSafe(F.col("doc_id")))
    kept = met.select("doc_id", "k", "text", "lines", "copy").mapInArrow(run, "doc_id long, k binary, copy boolean, kept string").distinct()
    kept = stored(kept.withColumnsRenamed({"doc_id": "d_", "k": "k_", "copy": "c_"}), "lines-kept")
    sizes = lost.select(F.col("doc_id").alias("d2"), F.col("k").alias("k2"), F.col("copy").alias("c2"), F.size("lines").cast("long").alias("lost"))
    every = rows.select("doc_id", "k", "n_lines", "sha256", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"))
    every = every.withColumn("copy", F.col("nth") > 1)
    out = (every.join(kept, every["doc_id"].eqNullSafe(kept["d_"]) & (every["k"] == kept["k_"]) & (every["copy"] == kept["c_"]), "left")
           .join(sizes, every["doc_id"].eqNullSafe(sizes["d2"]) & (every["k"] == sizes["k2"]) & (every["copy"] == sizes["c2"]), "left"))
    return out.select("doc_id", "n_lines", F.coalesce("lost", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("kept", "sha256").alias("kept_sha256"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines cut out of the texts, all other columns as they are."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    _, gone = removed_lines(plain, window)
    d, k, copies, lines, copy_lines, nth = fresh(docs, "d", "k", "copies", "lines", "copy_lines", "nth")
    gone = gone.select(F.col("doc_id").alias(d), F.col("k").alias(k), F.col("copies").alias(copies),
                       F.col("lines").alias(lines), F.col("copy_lines").alias(copy_lines))
    text = docs[text_col].cast("string")
    met = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[d]) & (_key(text) == gone[k]), "left")
    row = F.row_number().over(Window.partitionBy(d, k).orderBy(k))
    met = met.withColumn(nth, F.when(F.coalesce(copies, F.lit(1)) > 1, row).otherwise(1))
    drop = F.when(F.col(nth) > 1, F.col(copy_lines)).otherwise(F.col(lines))
    parts = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(parts, lambda p, i: ~F.array_contains(drop, i.cast("long"))), "\n")
    return met.select(*[F.when(F.size(drop) > 0, kept).otherwise(text).alias(c) if c == text_col else docs[c] for c in docs.columns])

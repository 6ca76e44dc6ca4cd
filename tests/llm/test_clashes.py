"""Functions that keep the columns of their input, on inputs that hold every helper's name."""
import random

import pytest
from pyspark.sql import functions as F

from tickerlens.llm import decontam, langid, lines, mixing, neardup

HELPERS = ["d", "k", "copies", "lines", "copy_lines", "nth", "_nth", "gone", "_gone", "_d", "_k", "id_", "source_", "hash_", "times_", "total_", "rows_",
           "copies_", "copy_", "_id", "_source", "_hash", "_times", "_total", "_rows", "_copies", "_copy", "n", "rep", "label", "node", "kept", "component_id",
           "removed", "rejected", "s", "block", "rank", "bucket", "row", "start", "size", "taken", "target", "text_hash", "w1", "w2", "at", "r", "item_id", "hits"]


@pytest.mark.parametrize("keep", [
    lines.deduplicate, mixing.mixed_documents, neardup.deduplicate, langid.keep_identified,
    lambda d: decontam.decontaminate(d, d.select(F.lit("x").alias("item_id"), F.lit("no such text at all in here").alias("text")))],
    ids=["lines", "mixing", "neardup", "langid", "decontam"])
def test_clashing_columns_stay(spark, keep):
    random.seed(1)
    own = "one line\nand two\nand three\n"
    rows = [(i // 2, random.choice([own, "", None, "the plain words of a text " * 9]) , "en", random.choice("ab")) for i in range(40)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = plain.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c.upper() if i % 3 == 0 else c) for i, c in enumerate(HELPERS)])
    want = sorted(map(repr, map(tuple, keep(plain).select("doc_id", "text", "lang", "source").collect())))
    out = keep(extra)
    assert out.columns == extra.columns
    got = out.collect()
    assert sorted(repr((r.doc_id, r.text, r.lang, r.source)) for r in got) == want
    assert all(r[c.upper() if i % 3 == 0 else c] == f"{c}{r.doc_id}" for r in got for i, c in enumerate(HELPERS))

"""Operator 11: how filters of a corpus interact, in every order they could be applied in.

Each document gets a mask with one bit for each filter that it fails. Documents are counted
per part and mask ("cells", at most 2^f of them a part, whatever the size of the corpus), and
a recursive CTE walks all prefixes of all orders: a level extends each prefix by a letter it
lacks, joins the part's cells, and emits the metrics of that step with the bits applied so far.
A prefix is measured once, however many orders begin with it; the f! full orders then look up
their prefixes. Work after the masks grows with the number of parts alone.

The duplicate filter fails a document whose text a smaller id has, anywhere in the table. The
smallest id of each text comes from a grouped minimum (one small row per text and task), and
documents meet it on (text, id), so copies of one text are spread by their ids.

Cases: null text counts as empty, null source as the empty string, as which both are one part;
a null id is never a duplicate and makes none; rows that repeat an id are documents of their
own, and equal in text none is smaller than the other; labels that repeat an id count if any
says so, null marks say nothing, labels of no document are ignored; an empty table has no parts
and gives no rows; other columns are ignored.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Failure conditions over text, n_chars (code points), n_words, n_distinct (words) and n_upper (A-Z).
CONDITIONS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_upper > 2 * n_chars",
    "D": r"rlike(text, '[#$%&*|]')",
}
DUPLICATE = "E"
MOST_FILTERS = 7  # 7! orders of 7 steps: 35,280 rows that the end of the walk broadcasts
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"),
                        text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    return words.select("doc_id", "part", "text", F.length("text").cast("long").alias("n_chars"),
                        F.size("words").cast("long").alias("n_words"), F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
                        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"))


def document_fails(docs: DataFrame, conditions: dict[str, str] = CONDITIONS, duplicate: str | None = DUPLICATE, *,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, part, fails, n): rows with their number; bit i of ``fails`` is the i-th filter,
    the duplicate filter coming last."""
    fails = F.lit(0)
    for i, condition in enumerate(conditions.values()):
        fails = fails + F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0))
    rows = (_measured(docs, id_col, text_col, source_col)
            .select("doc_id", "part", fails.alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest")))
    each = stored(rows.groupBy("digest", "doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    if duplicate is None:
        return each.select("doc_id", "part", "fails", "n")
    first = (each.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
             .withColumn("is_first", F.lit(True)))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (each.join(first, ["digest", "doc_id"], "left")
            .select("doc_id", "part", (F.col("fails") + F.when(copy, F.lit(1 << len(conditions))).otherwise(F.lit(0))).alias("fails"), "n"))


def mask_cells(fails: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, fails, n, good, toxic): documents, good and toxic ones, of each part and mask."""
    def marked(c: str) -> Column:
        return F.coalesce(F.max(F.col(c) == 1), F.lit(False))

    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(marked(good).alias("is_good"), marked(toxic).alias("is_toxic")).withColumn("salt", F.lit(0).cast("long")))
    # documents without an id find no label; salted, they don't meet in one task
    salt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0).cast("long"))
    met = fails.withColumn("salt", salt).join(known, ["doc_id", "salt"], "left")
    total = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).cast("long")
    return met.groupBy("part", "fails").agg(F.sum("n").cast("long").alias("n"), total("is_good").alias("good"), total("is_toxic").alias("toxic"))


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley) of every part, order of ``letters`` and step; ``cells`` as of ``mask_cells``."""
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters, not {letters!r}")
    spark, f = cells.sparkSession, len(letters)
    alphabet = ", ".join(f"'{x}'" for x in letters)
    packed = stored(cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells")), "audit-cells")
    bit = f"shiftleft(1, instr('{letters}', letter) - 1)"
    hit = f"c.fails & {bit} != 0"
    step = f"""aggregate(p.cells, named_struct('kept', 0L, 'removed', 0L, 'redundant', 0L, 'unique_fails', 0L, 'good_lost', 0L, 'toxic_lost', 0L), (a, c) -> named_struct(
        'kept', a.kept + if(c.fails & (w.applied | {bit}) = 0, c.n, 0L),
        'removed', a.removed + if({hit} AND c.fails & w.applied = 0, c.n, 0L),
        'redundant', a.redundant + if({hit} AND c.fails & w.applied != 0, c.n, 0L),
        'unique_fails', a.unique_fails + if(c.fails = {bit}, c.n, 0L),
        'good_lost', a.good_lost + if({hit} AND c.fails & w.applied = 0, c.good, 0L),
        'toxic_lost', a.toxic_lost + if({hit} AND c.fails & w.applied = 0, c.toxic, 0L)))"""
    walk = spark.sql(f"""
        WITH RECURSIVE walk (part, prefix, letter, applied, step, m) AS (
          SELECT part, '', '', 0, 0, named_struct('kept', 0L, 'removed', 0L, 'redundant', 0L, 'unique_fails', 0L, 'good_lost', 0L, 'toxic_lost', 0L)
          FROM {{cells}}
          UNION ALL
          SELECT w.part, concat(w.prefix, letter), letter, w.applied | {bit}, w.step + 1, {step}
          FROM (SELECT part, prefix, applied, step, explode(filter(array({alphabet}), (x, i) -> applied & shiftleft(1, i) = 0)) AS letter
                FROM walk WHERE step < {f}) w
          JOIN {{cells}} p ON w.part = p.part)
        SELECT part, prefix, letter, step, m.* FROM walk WHERE step > 0""", cells=packed)
    # the limit on a recursion's rows guards against endless ones; this one ends after f levels
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        walk = stored(walk, "audit-walk")
    finally:
        spark.conf.set(ROW_LIMIT, limit)
    orders = spark.sql(f"""
        WITH RECURSIVE o (filter_order, applied) AS (
          SELECT '', 0
          UNION ALL
          SELECT concat(filter_order, letter), applied | {bit}
          FROM (SELECT filter_order, applied, explode(filter(array({alphabet}), (x, i) -> applied & shiftleft(1, i) = 0)) AS letter FROM o)
          WHERE length(filter_order) < {f})
        SELECT filter_order, step, left(filter_order, step) AS prefix
        FROM o LATERAL VIEW explode(sequence(1, {f})) AS step WHERE length(filter_order) = {f}""")
    # a prefix of k letters begins (f - k)! orders
    begins = F.element_at(F.array(*[F.lit(math.factorial(f - k)) for k in range(1, f + 1)]), F.col("step"))
    shapley = walk.groupBy("part", "letter").agg(F.sum(F.col("removed") * begins).cast("long").alias("shapley"))
    return (walk.join(shapley, ["part", "letter"]).join(F.broadcast(orders), ["prefix", "step"])  # f! * f rows
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(docs: DataFrame, labels: DataFrame, conditions: dict[str, str] = CONDITIONS, duplicate: str | None = DUPLICATE,
          **columns: str) -> DataFrame:
    """``interactions`` of the filters over whole ``docs`` (``columns``: id_col, text_col, source_col)."""
    cells = mask_cells(document_fails(docs, conditions, duplicate, **columns), labels, id_col=columns.get("id_col", "doc_id"))
    return interactions(cells, "".join(conditions) + (duplicate or ""))

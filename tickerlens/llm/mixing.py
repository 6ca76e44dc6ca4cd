"""Operator 9: mixing sources to target weights by a low-discrepancy schedule.

DataFrame operations only. Each source's documents are shuffled (ordered by a seeded hash)
and laid end to end as a stream of words, cut into equal blocks. A target of words per
source follows from its weight; it fixes how many block slots the source has. The schedule
walks the golden-ratio points ``n * g mod Q`` (g near Q / 1.618 and prime to Q, so every
slot is met exactly once) and maps each through the cumulative slot counts to a source; the
n-th slot's rank among its source's slots says which block, in which pass, it takes.

Ranks and stream positions come from two-level prefix sums over buckets of about
sqrt(rows) rows, so a source with a third of all rows is spread over many tasks.

Targets: the sources, by code point with null last, weigh ``weights`` in rotation and share
``share`` times all words; a target stops at ``max_repeat`` times its source's words and the
excess goes to the others by weight, until none is above.

Cases: null or empty text has size 0 and takes nothing; null source is a source of its own;
repeated rows are rows of their own; without any words all targets are 0; an empty table
gives no rows; other columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.llm.tables import fresh, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1024
GOLDEN = (math.sqrt(5) - 1) / 2


def _bucket_rows(n: int) -> int:
    return max(64, 2 * math.isqrt(n))


def word_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, text_hash) of each row."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(text).alias("text_hash"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeat: float) -> DataFrame:
    """(source, s, source_size, weight, target): one row per source.

    With the sources by cap / weight, the level of words per unit of weight that remains
    when all before are at their caps is known at each; the first source whose cap lies
    above the level sets it, and a target is the smaller of cap and weight times level."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    names = (sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
             .withColumn("s", (F.row_number().over(by_name) - 1).cast("long"))
             .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (F.pmod(F.col("s"), F.lit(len(weights))) + 1).cast("int")))
             .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("s").asc())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(left)
    at = names.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("place", "level"))).over(everything)
    return (at.withColumn("final", first["level"])
            .withColumn("target", F.when(F.col("final").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("final"))))
            .select("source", "s", "source_size", "weight", "target"))


def slot_counts(targets: DataFrame, block: int) -> DataFrame:
    """Adds whole words wanted, blocks and slots of each source, and the slots before it.
    Slot r of a source takes block ``r mod n_blocks`` in pass ``r div n_blocks``."""
    b = F.lit(block)
    size, want = F.col("source_size"), F.col("want")
    passes = F.when(size > 0, F.floor((want - 1) / size)).otherwise(0)  # whole passes before the last
    return (targets.withColumn("want", F.round("target").cast("long"))
            .withColumn("n_blocks", F.ceil(size / b).cast("long"))
            .withColumn("slots", F.when(want > 0, passes * F.col("n_blocks") + F.ceil((want - passes * size) / b))
                        .otherwise(0).cast("long"))
            .withColumn("first_point", F.coalesce(F.sum("slots").over(
                Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")))


def _largest_quotient(g: int, n: int) -> int:
    """Largest partial quotient of the continued fraction of g / n; 0 if they share a factor.
    The points k * g / n are the more even the smaller it is; the golden ratio's are all 1."""
    most, a, b = 0, n, g
    while b:
        most, a, b = max(most, a // b), b, a % b
    return most if a == 1 else 0


def golden_step(n: int, around: int = 200) -> int:
    """The step near the golden section of n that gives the most even points."""
    middle = round(n * GOLDEN)
    near = [g for g in range(max(1, middle - around), min(n - 1, middle + around) + 1) if _largest_quotient(g, n)]
    return min(near, key=lambda g: (_largest_quotient(g, n), abs(g - middle)), default=1)


def schedule(counts: DataFrame, total: int) -> DataFrame:
    """(n, s, rank): which source the n-th slot goes to, and the slot's rank among its source's."""
    spark = counts.sparkSession
    width = max(1, -(-total // 1024))
    n_of = F.col("id")
    point = ((n_of.cast("decimal(20,0)") * F.lit(golden_step(max(1, total))).cast("decimal(18,0)"))
             % F.lit(max(1, total)).cast("decimal(18,0)")).cast("long")
    points = (spark.range(total).select(n_of.alias("n"), point.alias("point"))
              .withColumn("cell", F.floor(F.col("point") / F.lit(width)).cast("long")))
    ends = F.col("first_point") + F.col("slots")
    cells = (counts.where("slots > 0").select("s", "first_point", ends.alias("end_point"),
                                              F.explode(F.sequence(F.floor(F.col("first_point") / F.lit(width)).cast("long"),
                                                                   F.floor((ends - 1) / F.lit(width)).cast("long"))).alias("cell")))
    slots = (points.join(cells, "cell").where("point >= first_point AND point < end_point")
             .select("n", "s", F.floor(F.col("n") / F.lit(_bucket_rows(total))).cast("long").alias("run")))
    return _ranked(slots, "s", "run", [F.col("n")], F.lit(1), "rank")


def _ranked(rows: DataFrame, key: str, bucket: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the rows of the same key before each row, by (bucket, order)."""
    rows = rows.withColumn("_amount", amount.cast("long"))
    sums = rows.groupBy(key, bucket).agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(key, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .join(base, [key, bucket]).withColumn(name, (F.col("_base") + F.col("_in")).cast("long"))
            .drop("_amount", "_in", "_base"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0,
        block_words: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, taken) of each row of ``docs``."""
    sizes = stored(word_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    n_rows = sizes.count()
    block = block_words
    counts = stored(slot_counts(source_targets(sizes, weights, share, max_repeat), block), "mix-sources")
    total = counts.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    # each source's documents in shuffled order, as a stream of words
    key = F.xxhash64(F.lit(seed), "doc_id", "text_hash")
    n_buckets = max(1, n_rows // _bucket_rows(n_rows))
    placed = (sizes.join(counts.select("source", "s"), sizes["source"].eqNullSafe(counts["source"])).drop(counts["source"])
              .withColumn("key", key).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.lit(n_buckets))))
    inside = Window.partitionBy("s", "bucket").orderBy("key", "doc_id", "size")
    placed = placed.withColumn("row", F.row_number().over(inside))
    placed = _ranked(placed, "s", "bucket", [F.col("row")], F.col("size"), "start")

    # the part of each document in each block, and the slots that take the block
    b = F.lit(block)
    last = F.col("start") + F.col("size") - 1
    parts = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(
        F.floor(F.col("start") / b).cast("long"), F.floor(last / b).cast("long")))))
    lo = F.greatest(F.col("start"), F.col("block") * b)
    hi = F.least(last + 1, (F.col("block") + 1) * b)
    parts = parts.withColumn("offset", lo - F.col("block") * b).withColumn("words", hi - lo)
    taking = (schedule(counts, total).join(counts.select("s", "source_size", "want", "n_blocks"), "s")
              .withColumn("block", F.pmod(F.col("rank"), F.col("n_blocks")))
              .withColumn("pass_", F.floor(F.col("rank") / F.col("n_blocks")).cast("long"))
              .withColumn("limit_", F.least(b, F.col("want") - F.col("pass_") * F.col("source_size") - F.col("block") * b))
              .select("s", "block", "limit_"))
    # least and greatest skip nulls, so blocks that no slot takes are told apart first
    got = F.when(F.col("limit_").isNotNull(), F.greatest(F.lit(0), F.least(F.col("words"), F.col("limit_") - F.col("offset"))))
    taken = (parts.join(taking, ["s", "block"], "left").groupBy("s", "bucket", "row", "doc_id", "source", "text_hash", "size")
             .agg(F.coalesce(F.sum(got), F.lit(0)).cast("long").alias("taken")))
    return (taken.join(counts.select("s", "source_size", "target"), "s")
            .select("doc_id", "source", "text_hash", "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0, 1 or ``max_repeat`` times at
    most); a document that the end of a source's target cuts counts as whole if at least half is taken."""
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kw)
    id_, source, hash_, times, total, rows_, copies, copy = fresh(docs, "id_", "source_", "hash_", "times_", "total_", "rows_", "copies_", "copy_")
    key = [id_, source, hash_]
    each = (plan.select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("text_hash").alias(hash_),
                        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias(times))
            .groupBy(*key).agg(F.sum(times).alias(total), F.count(F.lit(1)).alias(rows_)).where(F.col(total) > 0))
    text = F.col(text_col).cast("string")
    rows = docs.select("*", F.col(id_col).cast("long").alias(id_), F.col(source_col).cast("string").alias(source),
                       F.xxhash64(text).alias(hash_))
    same = [rows[c].eqNullSafe(each[c]) for c in key]
    nth = F.row_number().over(Window.partitionBy(*[rows[c] for c in key]).orderBy(rows[id_]))
    # rows equal in id, source and text share their total evenly, the first ones taking the odd copies
    share = F.floor((F.col(total) + F.col(rows_) - nth) / F.col(rows_)).cast("int")
    out = rows.join(each, same).withColumn(copies, share).where(F.col(copies) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[rows[c] for c in docs.columns])

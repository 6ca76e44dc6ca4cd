"""Operator 2: exact top-k search by the threshold algorithm, in blocks.

Vectors are cut into blocks of some thousand rows and queries likewise; each pair of blocks
is one task's work (a stated query set against all rows). Within a block every dimension has
a list of the rows sorted by that component. A query reads all its lists from their best end
in rounds, scores each row it meets in full, and stops when its k-th score is above the
threshold, the score of an imaginary row that has every list's last value read: no unseen
row can then reach the result, not even by a tie. The block results merge in a window per query.

Scores are exact integers: float64 arithmetic where every product sum is below 2**53, else
Python integers, held to the range of a long.

Cases: null vectors, null ids and vectors with a null or non-finite component take no part;
components beyond the range of a long are held to it; vectors of different lengths compare as
if filled with zeros; of rows that repeat an id the smallest vector counts; ties go to the
smaller id; fewer than k candidates give fewer rows; an empty table gives none.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.session import ensure_shipped, scratch_path

BLOCK_ROWS = 2048
FIRST_DEPTH = 32
RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    lens = np.diff(col.offsets.to_numpy())
    if (lens == width).all():
        return flat.reshape(len(col), width)
    out = np.zeros((len(col), width), dtype=np.int64)
    out[np.arange(width) < lens[:, None]] = flat
    return out


def _lengths(t: pa.Table) -> int:
    off = t.column("vec").combine_chunks().offsets.to_numpy()
    return int(np.diff(off).max(initial=0))


def threshold_search(ids: np.ndarray, rows: np.ndarray, order: np.ndarray, query_id: int, q: np.ndarray, k: int):
    """(ids, scores) of the k best rows of one block for one query; ``order`` has, per
    dimension, the rows by ascending component."""
    n = len(ids)
    up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    seen = ids == query_id
    best_ids, best = ids[:0], rows[:0, 0] if rows.shape[1] else np.empty(0, rows.dtype)
    depth, step = 0, FIRST_DEPTH
    while True:
        to = min(n, step) if len(up) + len(down) else n
        new = np.zeros(n, dtype=bool)
        if len(up) + len(down):
            new[order[n - to:n - depth, up]] = True
            new[order[depth:to, down]] = True
        else:
            new[:] = True
        new &= ~seen
        at = np.flatnonzero(new)
        seen |= new
        best_ids = np.concatenate([best_ids, ids[at]])
        best = np.concatenate([best, rows[at] @ q])
        if len(best) > k:
            if best.dtype == object:
                top = sorted(range(len(best)), key=lambda i: (-best[i], best_ids[i]))[:k]
            else:
                top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
        if to == n or seen.all():
            return best_ids, best
        depth, step = to, step * 4
        if len(best) == k:
            bound = (q[up] * rows[order[n - to, up], up]).sum() + (q[down] * rows[order[to - 1, down], down]).sum()
            if best.min() > bound:
                return best_ids, best


def _search_block(cands: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    if not len(cands) or not len(queries):
        return RESULT.empty_table()
    width = max(_lengths(cands), _lengths(queries))
    rows, qs = _matrix(cands.column("vec"), width), _matrix(queries.column("vec"), width)
    ids, query_ids = cands.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()

    def most(a: np.ndarray) -> int:
        return max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))

    kind = np.float64 if most(rows) * most(qs) * max(1, width) < 1 << 53 else object
    rows, qs = rows.astype(kind), qs.astype(kind)
    order = np.argsort(rows, axis=0, kind="stable")
    out = [threshold_search(ids, rows, order, i, q, k) for i, q in zip(query_ids.tolist(), qs)]
    score = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for _, b in out for s in b], dtype=np.int64)
    return pa.table([np.repeat(query_ids, [len(b) for _, b in out]), np.concatenate([i for i, _ in out]), score], schema=RESULT)


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, vec) with components floor(scale * x), one row per id, only whole finite vectors."""
    x = F.col(vec_col).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (table.where(F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(whole, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("vec"))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def exact_topk(vectors: DataFrame, is_query: Column, k: int, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best rows (query_id, rank, vec_id, score) by inner product for each row of
    ``vectors`` (vec_id, vec: array<long>, unique ids) that satisfies ``is_query``."""
    spark = vectors.sparkSession
    ensure_shipped(spark)
    path = scratch_path(spark, "vectors")
    vectors.write.parquet(path)
    vectors = spark.read.schema("vec_id long, vec array<long>").parquet(path)
    queries = vectors.where(is_query)
    n_blocks = max(1, -(-vectors.count() // block_rows))
    n_parts = max(1, -(-queries.count() // block_rows))

    def to_all(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    c = (vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")).withColumn("part", to_all(n_parts)))
    q = (queries.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(n_parts)).cast("int"))
         .withColumn("block", to_all(n_blocks)))
    found = (c.groupBy("block", "part").cogroup(q.groupBy("block", "part"))
             .applyInArrow(lambda a, b: _search_block(a, b, k), "query_id long, vec_id long, score long"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

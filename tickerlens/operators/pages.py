"""Page-list set semantics (W2 backfill horizon, W3 whole-list dedupe).

A page list is one crawled list page: (list key) -> titles ordered by position.
Lists are compared whole without gathering them: a fingerprint per list comes
from partial aggregation, equal fingerprints are confirmed item by item with a
join, and the set logic (which list was seen first, how many distinct lists a
day adds) is aggregation over fingerprints.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def list_fingerprints(items: DataFrame, list_cols: list[str], pos_col: str = "pos",
                      title_col: str = "title", all_lists: DataFrame | None = None) -> DataFrame:
    """One row per list: list_cols + (n, f1, f2), a fingerprint of the whole
    ordered list built by partial aggregation - item count and two independent
    64-bit hashes of (position, title) summed exactly as decimals. Nothing is
    collected, so a list of any size is one small aggregation state.
    ``all_lists`` (e.g. the crawl plan) adds lists that came back empty
    (n = 0: all empty lists share one fingerprint)."""
    h1 = F.xxhash64(F.col(pos_col), F.col(title_col)).cast("decimal(38,0)")
    h2 = F.xxhash64(F.col(title_col), F.lit("|"), F.col(pos_col)).cast("decimal(38,0)")
    fp = items.groupBy(*list_cols).agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("f1"),
                                       F.sum(h2).alias("f2"))
    if all_lists is not None:
        zero = F.lit(0).cast("decimal(38,0)")
        fp = (all_lists.select(*list_cols).distinct().join(fp, list_cols, "left")
              .select(*list_cols, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                      F.coalesce("f1", zero).alias("f1"), F.coalesce("f2", zero).alias("f2")))
    return fp


def list_groups(items: DataFrame, list_cols: list[str], order: list[Column], group_by: list[str],
                pos_col: str = "pos", title_col: str = "title",
                all_lists: DataFrame | None = None) -> DataFrame:
    """Each list with ``is_rep``: True for the first list (``order``, smallest
    first) of every set of equal lists within ``group_by``. Equality is exact:
    lists sharing a fingerprint with their representative are confirmed by
    joining their items to the representative's items on (position, title);
    unconfirmed ones (a fingerprint collision) stay representatives of their own.
    A value shared by a third of all lists is one aggregation group plus a join
    whose skewed side AQE splits - never one collected array."""
    fp = list_fingerprints(items, list_cols, pos_col, title_col, all_lists)
    key = group_by + ["n", "f1", "f2"]
    rest = [c for c in list_cols if c not in group_by]
    reps = (fp.withColumn("_o", F.struct(*order))
            .groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), "_o").alias("_rep")))
    self_rep = None
    for c in rest:
        e = F.col(c) == F.col("_rep")[c]
        self_rep = e if self_rep is None else self_rep & e
    # one row per list, read several times below: computed once, lineage cut
    fp = materialize(fp.join(reps, key).withColumn("_self", self_rep))
    own = F.struct(*[F.col(c) for c in rest])
    others = fp.where(~F.col("_self"))
    if others.limit(1).count() == 0:  # no two lists share a fingerprint: all distinct
        return fp.select(*list_cols, "n", F.lit(True).alias("is_rep"), own.alias("group"))
    cand = others.where(F.col("n") > 0)
    # candidate items vs representative items, position by position
    ci = items.select(*list_cols, F.col(pos_col).alias("_p"), F.col(title_col).alias("_t")).join(
        cand.select(*list_cols, *[F.col("_rep")[c].alias(f"_r_{c}") for c in rest], "n"), list_cols)
    ri = items.select(*[F.col(c).alias(f"_r_{c}") for c in rest], *group_by,
                      F.col(pos_col).alias("_p"), F.col(title_col).alias("_t"))
    matched = (ci.join(ri, [f"_r_{c}" for c in rest] + group_by + ["_p", "_t"])
               .groupBy(*list_cols).agg(F.count(F.lit(1)).alias("_m"), F.first("n").alias("_n"))
               .where(F.col("_m") == F.col("_n")).select(*list_cols).withColumn("_dup", F.lit(True)))
    empty_dup = others.where(F.col("n") == 0).select(*list_cols).withColumn("_dup", F.lit(True))
    dups = matched.unionByName(empty_dup)
    return (fp.join(dups, list_cols, "left")
            .select(*list_cols, "n", (~F.coalesce(F.col("_dup"), F.lit(False))).alias("is_rep"),
                    F.when(F.coalesce(F.col("_dup"), F.lit(False)), F.col("_rep"))
                     .otherwise(F.struct(*[F.col(c) for c in rest])).alias("group")))


def dedupe_pages(items: DataFrame, list_cols: list[str], first_seen: list[Column],
                 pos_col: str = "pos", title_col: str = "title",
                 all_lists: DataFrame | None = None,
                 run_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Set semantics on whole lists - a list equal to one seen earlier (in
    ``first_seen`` order, smallest first) is dropped with all its titles; all
    empty lists count as one. With ``run_cols`` (a subset of ``list_cols``) the
    set is kept per run. Returns (kept items, kept lists)."""
    run_cols = run_cols or []
    g = list_groups(items, list_cols, first_seen, run_cols, pos_col, title_col, all_lists)
    dropped = g.where(~F.col("is_rep")).select(*list_cols)
    kept = g.where("is_rep").select(*list_cols, "n")
    if dropped.limit(1).count() == 0:
        return items, kept  # nothing to drop: the items pass through untouched
    return items.join(dropped, list_cols, "left_anti"), kept


def backfill_horizon(items: DataFrame, list_cols: list[str], date_col: str = "run_date",
                     min_lists: int = 10, pos_col: str = "pos", title_col: str = "title",
                     all_lists: DataFrame | None = None) -> DataFrame:
    """Walking back from the newest day, keep whole days until at least
    ``min_lists`` distinct lists are held. A list counts on the newest day it
    appears. Output: kept days with new and cumulative distinct-list counts.
    The only global window runs over one row per day."""
    order = [F.datediff(F.lit("9999-12-31"), F.col(date_col))] + [
        F.col(c) for c in list_cols if c != date_col]
    g = list_groups(items, list_cols, order, [], pos_col, title_col, all_lists)
    # the group's representative is its newest list: the day the list counts on
    per_day = (g.where("is_rep").groupBy(date_col).agg(F.count(F.lit(1)).alias("new_lists")))
    days = (g.select(date_col).distinct().join(per_day, date_col, "left")
            .withColumn("new_lists", F.coalesce("new_lists", F.lit(0)).cast("bigint")))
    w = Window.orderBy(F.col(date_col).desc())
    before = F.coalesce(F.sum("new_lists").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (days.withColumn("lists_before", before.cast("bigint"))
            .where(F.col("lists_before") < min_lists)
            .withColumn("lists_held", (F.col("lists_before") + F.col("new_lists")).cast("bigint")))


def look_back(days: list[str], read_days: Callable[[list[str]], DataFrame], list_cols: list[str],
              min_lists: int = 10, date_col: str = "run_date") -> tuple[DataFrame, list[str]]:
    """W2 as part of a run: (items, their days). ``days`` names the stored days from the run's
    own backwards; ``read_days`` reads some of them. Days are read newest first, one, then two,
    then four, until ``min_lists`` distinct lists are held, and the items are those of the days
    up to that horizon: older partitions are never listed or read. One row per day read comes
    to the driver."""
    n = 1
    while True:
        near = days[:n]
        held = backfill_horizon(read_days(near), list_cols, date_col, min_lists).select(
            F.date_format(date_col, "yyyy-MM-dd").alias("day"), "lists_held").collect()
        if n >= len(days) or any(r["lists_held"] >= min_lists for r in held):
            within = {r["day"] for r in held}
            kept = [d for d in near if d in within]
            return read_days(kept), kept
        n *= 2

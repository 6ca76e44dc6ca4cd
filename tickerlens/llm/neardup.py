"""Operator 3: near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct shingles of ``shingle`` words (fewer words: the whole
sequence). Documents with equal sets form a class at once, by a 128-bit set fingerprint. For
each class the ``K`` smallest shingle hashes are kept. Then

1. inverted lists: two sets of Jaccard similarity s share about ``s * K`` of the K smallest
   hashes of their union, at least ``shared(K)`` (six standard deviations below). So if each
   class lists its retained hashes from the rarest to the most frequent, the first
   ``K - shared(K) + 1`` of them meet; only these are posted. Passages that many documents
   share come last and are not posted unless a document consists of little else;
2. the lists give pairs whose sketches of the ``MINI`` smallest hashes are compared at once,
   in the join: a pair goes on only with ``shared(MINI)`` common values;
3. pairs that remain are confirmed on the full shingle sets of both texts.

A list of at most ``ALL_PAIRS`` classes gives all its pairs. A longer one gives the pairs
with some pivots, the first being its most typical member (with the most retained hashes that
others have, as the original of many near-copies), and linked pairs join components. To lose
no link, the members of long lists that still hold several components are then matched on
their full sets: a linked pair shares ``percent`` of the larger set, so of the hashes from the
rarest to the most frequent the first ``100 - percent`` percent meet, and a set with more
hashes of its own than that links with nothing. Only members outside the first pivot's
component look for partners. Copies and near-copies of one text so cost a few pairs each, not
the square of their number.

Cases: null, empty or word-less text has an empty set and links with nothing; rows that
repeat an id are one document with the links of all its texts; a null id takes no part
(component null, kept); an empty table gives no rows; other columns are ignored by
``duplicates`` and kept by ``deduplicate``.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlens.llm.tables import fresh, lean, stored
from tickerlens.session import ensure_shipped

K, MINI = 64, 32
ALL_PAIRS = 16
PIVOTS = 4
SEGMENT = 1 << 18
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = bytes(32 if b in (0x20, *range(0x09, 0x0E)) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
DOC = "doc_id long, n long, f1 long, f2 long, sketch array<long>, mini array<int>"


def shared(k: int, percent: int) -> int:
    """How many of the k smallest hashes of the union two linked sets share at least."""
    p = percent / 100
    return max(1, math.floor(k * p - 6 * math.sqrt(k * p * (1 - p))))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(int(_RADIX), SEGMENT + 1), _powers(pow(int(_RADIX), -1, 1 << 64), SEGMENT + 1)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer (the published splitmix64 step)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _segment_words(seg: bytes) -> np.ndarray:
    """Polynomial hash of each space-separated word of at most SEGMENT bytes of text."""
    b = np.frombuffer(seg, dtype=np.uint8)
    word = np.concatenate([[False], b != 32, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    lo, hi = edge[0::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _UP[:len(b)], dtype=np.uint64)])
    return (sums[hi] - sums[lo]) * _DOWN[lo]


def _long_word(word: bytes) -> np.ndarray:
    """The same polynomial for a word longer than a segment, piece by piece."""
    total, scale = 0, 1
    for i in range(0, len(word), SEGMENT):
        b = np.frombuffer(word[i:i + SEGMENT], dtype=np.uint8)
        total += scale * int(((b.astype(np.uint64) + np.uint64(1)) * _UP[:len(b)]).sum(dtype=np.uint64))
        scale = scale * int(_UP[SEGMENT]) & (2**64 - 1)
    return np.array([total & (2**64 - 1)], dtype=np.uint64)


def word_hashes(text: bytes) -> np.ndarray:
    data, out, at = text.translate(_TABLE), [], 0
    while at < len(data):
        end = len(data)
        if end - at > SEGMENT:
            cut = data.rfind(b" ", at, at + SEGMENT)
            end = cut if cut > at else at + SEGMENT
            if cut < at:  # a word from here on that is longer than a segment
                stop = data.find(b" ", at)
                end = len(data) if stop < 0 else stop
                out.append(_long_word(data[at:end]))
                at = end
                continue
            if cut == at:
                at += 1
                continue
        out.append(_segment_words(data[at:end]))
        at = end
    return mix(np.concatenate(out)) if out else np.empty(0, np.uint64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    w = word_hashes(text)
    n = min(size, len(w))
    if not n:
        return np.empty(0, np.uint64)
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h += mix(w[i:len(w) - n + 1 + i], i + 1)
    return np.unique(mix(h))


def shingle_set(text: bytes, size: int) -> set:
    w = text.translate(_TABLE).split()
    n = min(size, len(w))
    return set(zip(*(w[i:] for i in range(n)))) if n else set()


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, n, f1, f2, sketch, mini) of each row."""
    ensure_shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f1, f2, full, mini = [], [], [], [], []
            for cell in b.column(1):
                h = shingle_hashes(cell.as_buffer().to_pybytes() if cell.is_valid else b"", shingle)
                n.append(len(h))
                f1.append(mix(h, 11).sum(dtype=np.uint64).view(np.int64))
                f2.append(mix(h, 12).sum(dtype=np.uint64).view(np.int64))
                full.append(h[:K].view(np.int64))
                mini.append((h[:MINI] >> np.uint64(16)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                                              pa.array(full, pa.list_(pa.int64())), pa.array(mini, pa.list_(pa.int32()))],
                                             names=["doc_id", "n", "f1", "f2", "sketch", "mini"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), DOC)


def postings(reps: DataFrame, percent: int) -> DataFrame:
    """(v, rep, n, mini, typical): each class's rarest retained hashes that occur in another
    class; ``typical`` counts all of its retained hashes that do."""
    each = reps.select("rep", "n", F.explode("sketch").alias("v"))
    often = stored(each.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "neardup-frequent")
    common = (each.select("rep", "v").join(often, "v").groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("common")))  # at most K values
    kept = F.least(F.col("n"), F.lit(K))
    least = F.least(F.lit(shared(K, percent)), F.floor((F.col("n") * percent + 99) / 100))
    # the hashes of this class alone are its rarest, so they fill the first places
    take = F.greatest(F.lit(0), (kept - least + 1) - (kept - F.size("common"))).cast("int")
    return (reps.select("rep", "n", "mini").join(common, "rep")
            .select("rep", "n", "mini", F.size("common").alias("typical"), F.explode(F.slice("common", F.lit(1), take)["v"]).alias("v")))


def _may_link(percent: int) -> Column:
    """Sizes and small sketches of a and b allow a link."""
    lo, hi = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    need = F.least(F.lit(shared(MINI, percent)), F.floor((hi * percent + 99) / 100))
    return (lo * 100 >= hi * percent) & (F.size(F.array_intersect("mini_a", "mini_b")) >= need)


def _as(df: DataFrame, side: str, key: str, *cols: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{c}_{side}") for c in cols])


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def first_pairs(posts: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of short lists, and the pairs with the pivots of long ones."""
    cols = ("rep", "n", "mini")
    short = posts.join(lists.where(F.col("members") <= ALL_PAIRS).select("v"), "v")
    inside = (_as(short, "a", "v", *cols).join(_as(short, "b", "v", *cols), "v")
              .where((F.col("rep_a") < F.col("rep_b")) & _may_link(percent)))
    # each member with the different pivots of all its lists, few since the same ones stand out
    long_ = lists.where(F.col("members") > ALL_PAIRS).select("v", F.col("pivots.rep").alias("pivots"))
    to = (posts.join(long_, "v").groupBy("rep").agg(F.first("n").alias("n"), F.first("mini").alias("mini"),
                                                    F.collect_set("pivots").alias("pivots"))
          .select("rep", "n", "mini", F.explode(F.array_distinct(F.flatten("pivots"))).alias("p")))
    pivot = (lists.where(F.col("members") > ALL_PAIRS).select(F.explode("pivots").alias("p"))
             .groupBy(F.col("p.rep").alias("rep")).agg(F.first("p.n").alias("n"), F.first("p.mini").alias("mini")))
    star = (_as(to.where("rep <> p"), "a", "p", *cols).join(_as(pivot.withColumn("p", F.col("rep")), "b", "p", *cols), "p")
            .where(_may_link(percent)))
    return _pairs(inside.select("rep_a", "rep_b").unionByName(star.select("rep_a", "rep_b")))


def open_members(posts: DataFrame, lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(rep, label, other): members of long lists with several components; ``other`` if in one
    of its lists it is outside the first pivot's component."""
    long_ = lists.where(F.col("members") > ALL_PAIRS).select("v", F.col("pivots")[0]["rep"].alias("pivot"))
    member = (posts.select("v", "rep").join(long_, "v").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("label", F.coalesce("label", "rep")))
    main = labels.select(F.col("node").alias("pivot"), F.col("label").alias("main"))
    member = member.join(main, "pivot", "left").withColumn("other", F.col("label") != F.coalesce("main", "pivot"))
    member = stored(member.select("v", "rep", "label", "other"), "neardup-members")
    several = stored(member.groupBy("v").agg(F.max("other").alias("several")).where("several").select("v"), "neardup-several")
    return member.join(several, "v").groupBy("rep").agg(F.max("label").alias("label"), F.max("other").alias("other"))


def full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(rep, h): all shingle hashes of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rep, cell in zip(b.column(0), b.column(1)):
                h = shingle_hashes(cell.as_buffer().to_pybytes(), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([rep.as_py()], pa.int64()), pa.array([h.view(np.int64)], pa.list_(pa.int64()))],
                                                 names=["rep", "h"])
    return texts.mapInArrow(lean(run), "rep long, h array<long>")


def other_pairs(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs of different components that full sets allow, for the members marked other."""
    named = members.select("rep", "label", "other")
    sets = stored(full_sets(texts.select(F.col("doc_id").alias("rep"), "text").join(named.select("rep"), "rep"), shingle), "neardup-sets")
    each = sets.select("rep", F.size("h").alias("n"), F.explode("h").alias("v"))
    often = stored(each.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "neardup-frequent")
    # n, and m of them in other sets too; the hashes of one text
    common = (each.join(often, "v").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("common"))
              .withColumn("m", F.size("common")).where(F.col("m") * 100 >= F.col("n") * percent))
    own = F.col("n") - F.col("m")
    take = F.greatest(F.lit(0), F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1 - own).cast("int")
    first = common.select("rep", "n", own.alias("own"), F.slice("common", F.lit(1), take)["v"].alias("first"))
    posts = first.select("rep", "n", "own", "first", F.posexplode("first").alias("at", "v"))
    posts = stored(posts.select("rep", "n", (F.col("n") - F.col("own") - F.col("at")).alias("left"), "first", "v",
                                (F.col("n") - F.col("own") - F.size("first")).alias("rest")).join(named, "rep"), "neardup-full-postings")
    cols = ("rep", "n", "left", "rest", "first", "label", "other")
    # a pair is judged where it first meets; there both have at least their overlap left, and the
    # hashes that meet in the first places make up what the rest of the set cannot give
    need = (F.col("n_a") + F.col("n_b")) * percent
    meeting = F.array_intersect("first_a", "first_b")
    near = ((F.least("left_a", "left_b") * (100 + percent) >= need) & (F.get(meeting, 0) == F.col("v"))
            & ((F.size(meeting) + F.greatest("rest_a", "rest_b")) * (100 + percent) >= need)
            & (~F.col("other_b") | (F.col("rep_a") < F.col("rep_b"))))
    met = (_as(posts.where("other"), "a", "v", *cols).join(_as(posts, "b", "v", *cols), "v")
           .where((F.col("label_a") != F.col("label_b")) & near))
    return _pairs(met)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, set())
        for b in batches:
            ok = []
            for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2), b.column(3)):
                if last[0] != a:
                    last = (a, shingle_set(ta.as_buffer().to_pybytes(), shingle))
                    first = ta
                elif not ta.equals(first):  # another row of the same id
                    last, first = (a, shingle_set(ta.as_buffer().to_pybytes(), shingle)), ta
                other = shingle_set(tb.as_buffer().to_pybytes(), shingle)
                both = len(last[1] & other)
                ok.append(100 * both >= percent * (len(last[1]) + len(other) - both) and both > 0)
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(lean(run), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), by smallest labels of
    neighbours and of labels in turn until none changes."""
    both = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))), "components-edges")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "components-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), "label"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        step = stored(labels.join(near, "node").select("node", F.least("label", "near").alias("label"),
                                                       F.col("label").alias("old")), "components-step")
        of_label = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(step.join(of_label, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "old"),
                        "components-labels")
        if not labels.where("label != old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def joined_components(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``components`` of the edges that ``labels`` come from and of ``more`` together. Only the
    components that ``more`` joins take part in the rounds, each as its smallest node."""
    def at(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"of_{side}"))
    ends = more.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    roots = components(ends.where("a != b").distinct())
    root = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
    alone = roots.join(labels.select("node"), "node", "left_anti")
    return stored(labels.join(root, "label", "left").select("node", F.coalesce("root", "label").alias("label")).unionByName(alone),
                  "components-labels")


def shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(doc_id, rep) of the ids whose rows differ in their sets, None if there is none: such an
    id links the classes of all its rows."""
    one = F.struct("n", "f1", "f2")
    several = stored(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi"))
                     .where("lo != hi").select("doc_id"), "neardup-shared-ids")
    if not several.limit(1).count():
        return None
    own = rows.where("n > 0").join(several, "doc_id", "left_semi").select("doc_id", "n", "f1", "f2").distinct()
    return stored(own.join(classes, ["n", "f1", "f2"]).select("doc_id", "rep").distinct(), "neardup-ids")


def duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
               percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs``."""
    rows = stored(sketches(docs, id_col, text_col, shingle), "neardup-sketches")
    classes = stored(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")),
                     "neardup-classes")
    reps = (rows.join(classes.withColumnRenamed("rep", "doc_id"), ["n", "f1", "f2", "doc_id"], "left_semi")
            .select(F.col("doc_id").alias("rep"), "n", "sketch", "mini"))
    posts = stored(postings(reps, percent), "neardup-postings")
    order = [-F.col("typical"), *[F.lit(0)] * (PIVOTS - 1)]  # the most typical member, and some by chance
    pivots = [F.min(F.struct(o.alias("first"), F.xxhash64(F.lit(i), "rep").alias("order"), "rep", "n", "mini")).alias(f"p{i}")
              for i, o in enumerate(order)]
    lists = stored(posts.groupBy("v").agg(F.count(F.lit(1)).alias("members"), *pivots).where("members > 1")
                   .select("v", "members", F.array(*[F.struct(f"p{i}.rep", f"p{i}.n", f"p{i}.mini") for i in range(PIVOTS)]).alias("pivots")),
                   "neardup-lists")

    first = stored(first_pairs(posts, lists, percent), "neardup-pairs")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    wanted = first.select(F.col("a").alias("doc_id")).union(first.select("b")).union(
        posts.join(lists.where(F.col("members") > ALL_PAIRS).select("v"), "v").select("rep")).distinct()
    texts = stored(plain.join(wanted, "doc_id", "left_semi"), "neardup-texts")
    edges = stored(confirmed(first, texts, shingle, percent), "neardup-links")
    of_ids = shared_ids(rows, classes)
    if of_ids is not None:
        least = of_ids.groupBy("doc_id").agg(F.min("rep").alias("a"))
        edges = edges.unionByName(of_ids.join(least, "doc_id").select("a", F.col("rep").alias("b")).where("a != b"))
    labels = components(edges)
    members = stored(open_members(posts, lists, labels), "neardup-open")
    rest = stored(other_pairs(members, texts, shingle, percent), "neardup-pairs")
    if rest.limit(1).count():
        more = stored(confirmed(rest, texts, shingle, percent), "neardup-links")
        labels = joined_components(labels, more)

    named = (rows.drop("sketch", "mini").join(classes, ["n", "f1", "f2"], "left")
             .join(labels.withColumnRenamed("node", "rep"), "rep", "left"))
    if of_ids is None:
        named = named.withColumn("of_id", F.lit(None).cast("long"))
    else:  # rows without words of an id whose other rows have some
        of_id = (of_ids.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("doc_id", F.coalesce("label", "rep").alias("of_id")))
        named = named.join(of_id, "doc_id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep", "of_id", "doc_id"))
    return (named.withColumn("component_id", own)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, with all its columns."""
    found = stored(duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, percent=percent), "neardup-result")
    id_, nth = fresh(docs, "gone", "nth")
    gone = found.where("NOT kept").select(F.col("doc_id").alias(id_)).distinct()
    left = docs.join(gone, docs[id_col].cast("long") == gone[id_], "left_anti")
    if found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        row = F.row_number().over(Window.partitionBy(docs[id_col]).orderBy(docs[text_col]))
        left = left.withColumn(nth, row).where(F.col(nth).eqNullSafe(1) | docs[id_col].isNull()).select(*[docs[c] for c in docs.columns])
    return left

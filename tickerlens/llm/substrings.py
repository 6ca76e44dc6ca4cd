"""Operator 6: removal of repeated byte strings by a Burrows-Wheeler transform per shard.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

1. Sharding by content. Of each window of ``length`` bytes the ``GRAM``-byte substring with
   the smallest hash (the leftmost of equals) is its anchor; equal windows have equal anchors
   at equal places, so a window whose anchor occurs once is unique. Only anchors that occur
   again send their windows' segment on, and the anchor's hash picks the shard, so that all
   equal windows meet in one.
2. In a shard, distinct segments with their multiplicities are laid end to end and sorted by
   their first symbols, more than ``length`` of them, which gives the transform. Intervals of rows that share a prefix
   are extended backwards breadth-first; each new interval end is a place where the common
   prefix of two neighbour rows has the current length. So common prefixes come by increasing
   value, and the search stops at ``length``: rows not parted by then share ``length`` bytes.
3. An anchor that sends more than ``HOT`` bytes (segments, equal ones of a text once, and 8 for
   each place) would fill its shard: its segments are first counted by content, and the windows
   of the distinct ones are then counted by a 128-bit hash.

Texts that are equal as a whole form a class whose members, if long enough, go entirely;
one of them stands for the class in the search.

Cases: null or empty text has no bytes; texts below ``length`` bytes lose nothing; overlapping
occurrences in one document count; rows that repeat an id, or a null id, are documents of
their own; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.neardup import mix
from tickerlens.llm.tables import stored
from tickerlens.session import ensure_shipped

LENGTH, GRAM = 200, 32
SHARD_BYTES = 2 << 20
HOT = SHARD_BYTES  # no anchor sends a shard more than a shard's mean
PIECE = 1 << 18  # windows looked at together in a long text
FIRST = 7  # symbols of 9 bits in a first sort key
ROWS = "doc_id long, k binary, n_bytes long, sha256 string, h array<long>, c array<long>"


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position."""
    n = len(data) - GRAM + 1
    at = np.ndarray((n + GRAM - 8,), "<u8", np.ascontiguousarray(data), strides=(1,)).copy()  # 8 bytes from each position
    h = at[:n] * np.uint64(0x9FB21C651E98DF25)
    for i in range(8, GRAM, 8):
        h ^= h >> np.uint64(32)
        h ^= at[i:i + n]
        h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive keys, from running minima of blocks of w."""
    n = len(keys)
    pad = -n % w
    k = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(k, axis=1).ravel()
    back = np.minimum.accumulate(k[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position of each window, hash at each of these positions), in window order."""
    windows, w = len(data) - length + 1, length - GRAM + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, hashes = [], []
    for i in range(0, windows, PIECE):
        part = data[i:min(len(data), i + PIECE + length - 1)]
        h = _grams(part)
        low = np.uint64((1 << 20) - 1)  # a piece has fewer grams than 2**20, so places fit below
        best = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), w)
        at = (best & low).astype(np.int64)
        places.append(at + i)
        hashes.append(h[at])
    return np.concatenate(places), np.concatenate(hashes)


def _text(cell) -> bytes:
    return cell.as_buffer().to_pybytes() if cell.is_valid else b""


def _first_windows(at: np.ndarray) -> np.ndarray:
    """The first window of each run of windows with one anchor."""
    return np.flatnonzero(np.concatenate([at[:1] >= 0, at[1:] != at[:-1]]))


def scan(docs: DataFrame, length: int) -> DataFrame:
    """Digest and size of each text, its different anchor hashes and how often it has each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, n, sha, hs, cs = [], [], [], [], []
            for cell in b.column(1):
                text = _text(cell)
                at, h = anchors(np.frombuffer(text, dtype=np.uint8), length)
                own, count = np.unique(h[_first_windows(at)], return_counts=True)
                k.append(hashlib.md5(text, usedforsecurity=False).digest())
                n.append(len(text))
                sha.append(hashlib.sha256(text).hexdigest())
                hs.append(own.view(np.int64))
                cs.append(count)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(k, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                                              pa.array(hs, pa.list_(pa.int64())), pa.array(cs, pa.list_(pa.int64()))],
                                             names=["doc_id", "k", "n_bytes", "sha256", "h", "c"])
    return docs.mapInArrow(run, ROWS)


def segments(found: DataFrame, length: int) -> DataFrame:
    """(h, k, starts, content): the windows of each repeated anchor as one piece of text,
    with all places where the text has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, cell, wanted in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                text = _text(cell)
                at, h = anchors(np.frombuffer(text, dtype=np.uint8), length)
                wanted = wanted.values.to_numpy()
                order = np.argsort(wanted)
                first = _first_windows(at)
                end = np.append(first[1:], len(at))
                own = h[first].view(np.int64)
                where = order[np.minimum(np.searchsorted(wanted[order], own), len(wanted) - 1)]
                again = wanted[where] == own
                rows: dict[tuple[int, bytes], list[int]] = {}
                for i, x, y in zip(where[again].tolist(), first[again].tolist(), end[again].tolist()):
                    rows.setdefault((i, text[x:y - 1 + length]), []).append(x)
                at_ = [i for i, _ in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted[at_]), pa.array([k] * len(rows), pa.binary()), pa.array(list(rows.values()), pa.list_(pa.int64())),
                     pa.array([c for _, c in rows], pa.binary())], names=["h", "k", "starts", "content"])
    return found.select("k", "text", "h").mapInArrow(run, "h long, k binary, starts array<long>, content binary")


def hot_anchors(cut: DataFrame, hot: int) -> DataFrame:
    """The anchors whose segments and places are more than ``hot`` bytes in a shard."""
    load = F.length("content") + 8 * F.size("starts")
    return cut.groupBy("h").agg(F.sum(load.cast("long")).alias("load")).where(F.col("load") > hot).select("h")


def _sorted_rows(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their next ``depth`` symbols at least, and their first keys in that
    order: a key of FIRST symbols, then rank pairs of doubling length."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(FIRST, symbols.dtype)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(FIRST):
        key = (key << np.uint64(9)) | padded[i:i + n]
    order = np.argsort(key)
    first = key[order]
    rank, size = np.empty(n, dtype=np.int64), FIRST
    new = np.concatenate([[0], np.cumsum(first[1:] != first[:-1])])
    rank[order] = new + 1
    while size < depth and new[-1] < n - 1:
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:max(0, n - size)] = rank[size:]
        pair = rank * (n + 2) + nxt
        order = np.argsort(pair)
        p = pair[order]
        new = np.concatenate([[0], np.cumsum(p[1:] != p[:-1])])
        rank[order] = new + 1
        size *= 2
    return order, key[order]


def repeated_rows(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in row order, row ends): row i and i + 1 differ within ``length`` symbols
    where ends[i + 1] is true. By breadth-first backward extension on the transform."""
    n = len(symbols)
    order, key = _sorted_rows(symbols, length + 2)
    before = symbols[order - 1]  # the transform; the text is taken as a ring
    lf = np.empty(n, dtype=np.int64)  # row of the symbol before
    lf[np.argsort(before.astype(np.uint16), kind="stable")] = np.arange(n)
    # common prefixes below FIRST symbols are plain in the first keys
    differ = key[1:] ^ key[:-1]
    common = np.full(n + 1, -1, dtype=np.int16)
    common[0] = common[n] = 0
    inner = np.full(n - 1, FIRST, dtype=np.int16)
    for i in range(FIRST):
        mask = np.uint64(0x1FF) << np.uint64(9 * i)
        inner[(differ & mask) != 0] = FIRST - 1 - i
    common[1:n] = np.where(inner < FIRST, inner, -1)
    edge = np.flatnonzero(common >= 0)
    lo, hi = edge[:-1], edge[1:]
    new = (common[hi] == FIRST - 1)
    lo, hi = lo[new], hi[new]
    for size in range(FIRST, length):  # intervals of prefixes of this many symbols
        if not len(lo):
            break
        count = hi - lo
        which = np.repeat(np.arange(len(lo)), count)
        rows = np.arange(len(which)) + np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        single = count == 1
        if single.all():
            left = lf[lo]
            right = left + 1
        else:  # rows of an interval by the symbol before them; those of one symbol are an interval again
            key = (which * 512 + before[rows]) * len(rows) + np.arange(len(rows))
            key.sort()
            tag, place = key // len(rows), key % len(rows)
            cut = np.flatnonzero(np.diff(tag, prepend=-1))
            left = lf[rows[place[cut]]]
            right = left + np.diff(np.append(cut, len(key)))
        fresh = common[right] < 0
        left, right = left[fresh], right[fresh]
        common[right] = size
        lo, hi = left, right
    return order, common >= 0


def repeated_windows(contents: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct segment the offsets of its windows that occur again in any segment,
    or in the segment's own copies."""
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    symbols = np.frombuffer(b"\0".join(contents) + b"\0", dtype=np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    order, part = repeated_rows(symbols, length)
    group = np.cumsum(part[:-1]) - 1
    total = np.bincount(group, weights=weights[owner[order]])
    again = np.zeros(len(symbols), dtype=bool)
    again[order] = total[group] >= 2
    again &= np.arange(len(symbols)) + length <= ends[owner] - 1  # whole windows of one segment
    hits = np.flatnonzero(again)
    at = np.searchsorted(hits, np.concatenate([[0], ends]))
    first = ends - sizes - 1
    return [hits[a:b] - f for a, b, f in zip(at, at[1:], first)]


COVER = pa.schema([("k", pa.binary()), ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))])


def _cover(ks: list[bytes], starts: list[np.ndarray], length: int) -> pa.Table:
    """Per text, the bytes that windows from the given starts cover, as ranges; row i of
    ``starts`` belongs to text ``ks[i]``."""
    names: dict[bytes, int] = {}
    which = np.repeat(np.array([names.setdefault(k, len(names)) for k in ks], dtype=np.int64), [len(x) for x in starts])
    if not len(which):
        return COVER.empty_table()
    at = np.concatenate(starts)
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    new_text = np.diff(which, prepend=-1) != 0
    new = new_text | (np.diff(at, prepend=0) > length)
    first = np.flatnonzero(new)
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1] + length
    text_of = which[first]
    cut = np.flatnonzero(np.diff(text_of, prepend=-1))
    offsets = pa.array(np.append(cut, len(first)), pa.int32())
    keys = list(names)
    return pa.table([pa.array([keys[i] for i in text_of[cut].tolist()], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(lo)),
                     pa.ListArray.from_arrays(offsets, pa.array(hi))], schema=COVER)


def _shard(rows: pa.Table, length: int) -> pa.Table:
    contents: dict[bytes, int] = {}
    which = [contents.setdefault(c, len(contents)) for c in rows.column("content").to_pylist()]
    places = [np.array(x) for x in rows.column("starts").to_pylist()]
    weights = np.bincount(which, weights=[len(x) for x in places])
    found = repeated_windows(list(contents), weights, length)
    return _cover(rows.column("k").to_pylist(), [np.add.outer(x, found[i]).ravel() for x, i in zip(places, which)], length)


def _window_hashes(content: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit polynomial hashes of every window of a segment."""
    b = np.frombuffer(content, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    out = []
    for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(b), base, np.uint64)]))
        down = np.uint64(pow(base, -1, 1 << 64))
        down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(b), down, np.uint64)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(b * up[:-1], dtype=np.uint64)])
        n = len(b) - length + 1
        out.append(mix((sums[length:] - sums[:n]) * down[:n]).view(np.int64))
    return out[0], out[1]


def hot_covers(hot: DataFrame, length: int) -> DataFrame:
    """Covers of the segments of very frequent anchors: by counted contents, then by counted
    windows of the distinct contents."""
    keyed = hot.select("h", F.md5("content").alias("c"), "k", "starts", "content")
    distinct = stored(keyed.groupBy("h", "c").agg(F.sum(F.size("starts")).alias("n"), F.first("content").alias("content")), "substrings-hot")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, c, n, content in zip(*(b.column(x).to_pylist() for x in ("h", "c", "n", "content"))):
                w1, w2 = _window_hashes(content, length)
                size = len(w1)
                yield pa.RecordBatch.from_arrays([pa.array([h] * size, pa.int64()), pa.array([c] * size, pa.string()), pa.array([n] * size, pa.int64()),
                                                  pa.array(np.arange(size)), pa.array(w1), pa.array(w2)], names=["h", "c", "n", "off", "w1", "w2"])

    each = distinct.mapInArrow(windows, "h long, c string, n long, off long, w1 long, w2 long")
    often = stored(each.groupBy("w1", "w2").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("segments"))
                   .where("n > 1"), "substrings-hot-windows")
    # windows repeated by their own segment's copies need no lookup; the others are few
    own = each.where("n > 1").select("h", "c", "off")
    met = each.where("n = 1").join(often.where("segments > 1").select("w1", "w2"), ["w1", "w2"]).select("h", "c", "off")
    offs = stored(own.unionByName(met).groupBy("h", "c").agg(F.sort_array(F.collect_list("off")).alias("offs")), "substrings-hot-offsets")
    where = stored(keyed.drop("content"), "substrings-hot-places")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts = [np.add.outer(x.values.to_numpy(), o.values.to_numpy()).ravel() for x, o in zip(b.column(1), b.column(2))]
            yield from _cover(b.column(0).to_pylist(), starts, length).to_batches()

    return where.join(offs, ["h", "c"]).select("k", "starts", "offs").mapInArrow(cover, "k binary, lo array<long>, hi array<long>")


def _merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    cut = np.flatnonzero(lo[1:] > hi[:-1])
    return lo[np.append(0, cut + 1)], hi[np.append(cut, len(hi) - 1)]


def removals(found: DataFrame, covers: DataFrame) -> DataFrame:
    """(k, lo, hi, n_removed, n_spans, kept_sha256) of each class that loses bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            los, his, gone, sha = [], [], [], []
            for cell, parts in zip(b.column(1), b.column(2).to_pylist()):
                text = _text(cell)
                lo, hi = _merge(np.concatenate([p["lo"] for p in parts]), np.concatenate([p["hi"] for p in parts]))
                keep, at = hashlib.sha256(), 0
                for x, y in zip(lo.tolist(), hi.tolist()):
                    keep.update(text[at:x])
                    at = y
                keep.update(text[at:])
                los.append(lo)
                his.append(hi)
                gone.append(int((hi - lo).sum()))
                sha.append(keep.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(los, pa.list_(pa.int64())), pa.array(his, pa.list_(pa.int64())),
                                              pa.array(gone, pa.int64()), pa.array([len(x) for x in los], pa.int64()), pa.array(sha, pa.string())],
                                             names=["k", "lo", "hi", "n_removed", "n_spans", "kept_sha256"])
    # ranges of one text
    per = covers.groupBy("k").agg(F.collect_list(F.struct("lo", "hi")).alias("parts"))
    return (found.select("k", "text").join(per, "k").select("k", "text", "parts")
            .mapInArrow(run, "k binary, lo array<long>, hi array<long>, n_removed long, n_spans long, kept_sha256 string"))


def repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed ranges (removed_from,
    removed_to) of each row of ``docs``; ``length`` must be above ``GRAM``."""
    ensure_shipped(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(scan(plain, length), "substrings-rows")
    classes = stored(rows.groupBy("k").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.first("h").alias("h"),
                                           F.first("c").alias("c")), "substrings-classes")
    each = classes.select("k", F.inline(F.arrays_zip("h", "c")))
    often = stored(each.groupBy("h").agg(F.sum("c").alias("n")).where("n > 1").select("h"), "substrings-anchors")
    again = each.select("k", "h").join(often, "h").groupBy("k").agg(F.collect_list("h").alias("h"))  # anchors of one text
    wanted = stored(again.join(classes.select("k", "rep"), "k"), "substrings-wanted").withColumnRenamed("k", "k_")
    text = plain.where("text IS NOT NULL").withColumn("k", F.unhex(F.md5("text")))
    found = stored(text.join(wanted, (F.col("k") == F.col("k_")) & F.col("doc_id").eqNullSafe(F.col("rep")))
                   .select("k", "text", "h"), "substrings-texts")

    cut = stored(segments(found, length), "substrings-segments")
    hots = stored(hot_anchors(cut, hot), "substrings-hot-anchors")
    usual = cut.join(hots, "h", "left_anti")
    n_shards = max(1, -(-(usual.agg(F.coalesce(F.sum(F.length("content")), F.lit(0))).first()[0]) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("h"), F.lit(n_shards))
    covers = (usual.select(shard.alias("shard"), "k", "starts", "content").groupBy("shard")
              .applyInArrow(lambda t: _shard(t, length), "k binary, lo array<long>, hi array<long>"))
    covers = stored(covers.unionByName(hot_covers(cut.join(hots, "h", "left_semi"), length)), "substrings-covers")
    lost = removals(found.dropDuplicates(["k"]), covers)

    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    every = stored(classes.select("k", "copies").join(lost, "k", "left"), "substrings-result")
    one = F.array(F.lit(0).cast("long"))
    none = F.expr("cast(array() as array<bigint>)")
    return (rows.select("doc_id", "k", "n_bytes", "sha256").join(every, "k")
            .select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
                    F.when(whole, one).otherwise(F.coalesce("lo", none)).alias("removed_from"),
                    F.when(whole, F.array("n_bytes")).otherwise(F.coalesce("hi", none)).alias("removed_to")))

"""Operator 8: benchmark decontamination by suffix arrays over the training documents.

Each task takes a shard of whole documents (some MB), numbers their words by the benchmark's
vocabulary, sorts the positions that can begin a test suffix into a word suffix array, and
binary-searches every test suffix in it: the interval found holds all locations of the
suffix's first window, and each location is extended to its longest verbatim match. Nothing
of the documents is shuffled. The benchmark is written once as blocks of bounded size in the
shared folder; a task reads one block at a time, so its size is free.

Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII.
A window is ``window`` consecutive words of an item; a shorter item is one window. A document
word inside any occurrence of a window is hit; a document is contaminated when it has hits
and they are at least 1 / ``one_in`` of its words.

Cases: null or empty text has no words and is clean; an item without words or without an id
takes no part; items that repeat an id count once; an empty benchmark hits nothing; matches
never cross documents; other columns are ignored by ``contamination`` and kept by
``decontaminate``.
"""
from __future__ import annotations

import hashlib
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm import files
from tickerlens.llm.tables import lean
from tickerlens.session import ensure_shipped, scratch_path

SHARD_BYTES = 4 << 20
BLOCK_CHARS = 16 << 20  # benchmark text in one block
_KEEP = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TABLE = bytes(b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def numbered(texts: list[bytes], vocab: dict[bytes, int]) -> tuple[np.ndarray, list[int]]:
    """The numbers of all texts' words, 0 for other words and for a gap after each text, and how
    many words each text has. Only one text's words are held at a time."""
    ids, counts = array("i"), []
    for t in texts:
        before = len(ids)
        ids.extend(map(vocab.get, words(t), itertools.repeat(0)))
        counts.append(len(ids) - before)
        ids.append(0)
    return np.frombuffer(ids, dtype=np.int32), counts


class TestBlock:
    """The test suffixes of one block of items, as packed keys of their first window."""

    def __init__(self, item_ids: list[str], texts: list[bytes], window: int):
        self.vocab: dict[bytes, int] = {}
        self.items: list[tuple[str, np.ndarray]] = []
        for i, t in zip(item_ids, texts):
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(t)], dtype=np.int64)
            if len(ids):
                self.items.append((i, ids))
        self.bits = max(1, len(self.vocab).bit_length())
        self.per_key = min(window, 64 // self.bits)
        self.n_keys = -(-window // self.per_key)
        # distinct windows, the items that have each, and each item's places of it
        wins: dict[bytes, int] = {}
        rows, self.owners = [], []
        for n, (_, ids) in enumerate(self.items):
            size = min(window, len(ids))
            for j in range(len(ids) - size + 1):
                key = ids[j:j + size].tobytes()
                if key not in wins:
                    wins[key] = len(wins)
                    rows.append(ids[j:j + size])
                    self.owners.append([])
                self.owners[wins[key]].append((n, j))
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        low = np.zeros((len(rows), self.n_keys * self.per_key), dtype=np.uint64)
        high = np.full_like(low, (1 << self.bits) - 1)
        for i, r in enumerate(rows):
            low[i, :len(r)] = high[i, :len(r)] = r.astype(np.uint64)
        self.low, self.high = self._pack(low), self._pack(high)
        # the first words that every window has at least
        self.head = min(self.per_key, int(self.lengths.min(initial=window)))
        self.heads = np.unique(self.low[0] >> np.uint64(self.bits * (self.per_key - self.head))) if rows else np.empty(0, np.uint64)

    def _pack(self, cells: np.ndarray) -> list[np.ndarray]:
        out = []
        for k in range(self.n_keys):
            key = np.zeros(len(cells), dtype=np.uint64)
            for c in range(self.per_key):
                key = (key << np.uint64(self.bits)) | cells[:, k * self.per_key + c]
            out.append(key)
        return out


class SuffixArray:
    """Word suffix array of a shard, over the positions whose first words begin a test window."""

    def __init__(self, corpus: np.ndarray, block: TestBlock):
        self.corpus, self.block = corpus, block
        span = block.n_keys * block.per_key
        padded = np.concatenate([corpus, np.zeros(span, dtype=corpus.dtype)])
        n, bits = len(corpus), np.uint64(block.bits)
        at = np.flatnonzero(corpus)
        head = np.zeros(len(at), dtype=np.uint64)
        for c in range(block.head):
            head = (head << bits) | padded[at + c].astype(np.uint64)
        place = np.searchsorted(block.heads, head)
        place[place == len(block.heads)] = 0
        at = at[block.heads[place] == head] if len(block.heads) else at[:0]
        keys = []
        for k in range(block.n_keys):
            key = np.zeros(len(at), dtype=np.uint64)
            for c in range(block.per_key):
                key = (key << bits) | padded[at + (k * block.per_key + c)].astype(np.uint64)
            keys.append(key)
        order = np.lexsort(keys[::-1]) if len(at) else np.empty(0, dtype=np.int64)
        self.places, self.keys, self.size = at[order], [k[order] for k in keys], n

    def _search(self, wanted: list[np.ndarray], or_equal: bool) -> np.ndarray:
        """Per test suffix, the number of corpus suffixes below it (or not above it)."""
        lo = np.zeros(len(wanted[0]), dtype=np.int64)
        hi = np.full(len(wanted[0]), len(self.places), dtype=np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            probe = np.minimum(mid, len(self.places) - 1)
            below = np.full(len(lo), or_equal)
            for have, want in zip(reversed(self.keys), reversed(wanted)):
                have = have[probe]
                below = (have < want) | ((have == want) & below)
            lo = np.where(open_ & below, mid + 1, lo)
            hi = np.where(open_ & ~below, mid, hi)
        return lo

    def locate(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) of every occurrence of a test window."""
        if not len(self.places) or not len(self.block.lengths):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lo, hi = self._search(self.block.low, False), self._search(self.block.high, True)
        n = hi - lo
        win = np.repeat(np.arange(len(n)), n)
        first = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return win, self.places[first + np.arange(len(win))]


def _load_blocks(paths: list[str], window: int) -> Iterator[TestBlock]:
    for p in paths:
        fs, path = files.filesystem(p)
        t = pq.read_table(path, filesystem=fs)
        yield TestBlock(t.column("item_id").to_pylist(), [x.encode() for x in t.column("text").to_pylist()], window)


def write_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[str]:
    """The benchmark as files of bounded size in the shared folder; their paths."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")).dropna()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    path = scratch_path(spark, "benchmark")
    items.repartition(max(1, -(-chars // BLOCK_CHARS)), F.xxhash64("item_id", "text")).write.parquet(path)
    return sorted(r[0] for r in spark.read.schema(items.schema).parquet(path).select(F.input_file_name()).distinct().collect())


def _local(uri: str) -> str:
    """input_file_name() percent-encodes; file URIs come with one or three slashes."""
    from urllib.parse import unquote
    return "file://" + unquote(uri[5:]).replace("//", "", 1) if uri.startswith("file:///") else unquote(uri)


class Judge:
    """Hits of documents against all blocks of a benchmark."""

    def __init__(self, paths: list[str], window: int):
        self.paths, self.window = paths, window
        self.single = next(_load_blocks(paths, window)) if len(paths) == 1 else None

    def blocks(self) -> Iterator[TestBlock]:
        return iter([self.single]) if self.single is not None else _load_blocks(self.paths, self.window)

    def shard(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[set[str]], list[tuple]]:
        """(n_words, n_hit, items, matches) of each document; a match is (document, word,
        item, word of the item, longest verbatim length)."""
        n_words = cover = starts = None
        items: list[set[str]] = [set() for _ in texts]
        matches = []
        for block in self.blocks():
            corpus, counts = numbered(texts, block.vocab)
            if cover is None:
                n_words, cover = np.array(counts, dtype=np.int64), np.zeros(len(corpus) + 1, dtype=np.int32)
                starts = np.concatenate([[0], np.cumsum(n_words + 1)])  # a gap word ends each document
            win, place = SuffixArray(corpus, block).locate()
            np.add.at(cover, place, 1)
            np.add.at(cover, place + block.lengths[win], -1)
            docs = np.searchsorted(starts, place, side="right") - 1
            for w, p, doc in zip(win.tolist(), place.tolist(), docs.tolist()):
                for n, j in block.owners[w]:
                    name, ids = block.items[n]
                    items[doc].add(name)
                    if j and p and corpus[p - 1] == ids[j - 1]:
                        continue  # part of a match that began earlier
                    size = int(block.lengths[w])
                    while j + size < len(ids) and corpus[p + size] == ids[j + size]:
                        size += 1
                    matches.append((doc, p - int(starts[doc]), name, j, size))
        if cover is None:  # an empty benchmark
            n_words = np.array([len(words(t)) for t in texts], dtype=np.int64)
            return n_words, np.zeros(len(texts), np.int64), items, matches
        hit = np.cumsum(cover[:-1], dtype=np.int32) > 0
        n_hit = np.add.reduceat(hit, starts[:-1], dtype=np.int64) if len(texts) else np.empty(0, np.int64)
        return n_words, n_hit, items, matches


def _shards(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, int, list[bytes]]]:
    texts, size, first = [], 0, 0
    for i, cell in enumerate(batch.column(text_at)):
        texts.append(cell.as_buffer().to_pybytes() if cell.is_valid else b"")
        size += len(texts[-1])
        if size >= SHARD_BYTES:
            yield first, i + 1, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, batch.num_rows, texts


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13, one_in: int = 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    the matches (word, item_id, item_word, length), longest verbatim each."""
    ensure_shipped(docs.sparkSession)
    paths = [_local(p) for p in write_blocks(benchmark, item_id_col, item_text_col)]
    match = pa.struct([("word", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(paths, window)
        for b in batches:
            for lo, hi, texts in _shards(b, 1):
                n_words, n_hit, items, matches = judge.shard(texts)
                found: list[list] = [[] for _ in texts]
                for doc, word, item, item_word, size in matches:
                    found[doc].append({"word": word, "item_id": item, "item_word": item_word, "length": size})
                sha = [hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() for s in items]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words), pa.array(n_hit), pa.array([len(s) for s in items], pa.int64()),
                     pa.array(sha, pa.string()), pa.array((n_hit > 0) & (one_in * n_hit >= n_words)), pa.array(found, pa.list_(match))],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
                                "matches array<struct<word: long, item_id: string, item_word: long, length: long>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, one_in: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    ensure_shipped(docs.sparkSession)
    paths = [_local(p) for p in write_blocks(benchmark, item_id_col, item_text_col)]
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(paths, window)
        for b in batches:
            for lo, hi, texts in _shards(b, text_at):
                n_words, n_hit, _, _ = judge.shard(texts)
                yield b.slice(lo, hi - lo).filter(pa.array((n_hit == 0) | (one_in * n_hit < n_words)))

    return docs.mapInArrow(lean(run), docs.schema)

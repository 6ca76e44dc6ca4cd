"""Operator 1: documents as flat token-id files with 64-bit offsets, and back.

Format, in one folder of the shared store:

* ``<shard>.bin``  ids of the shard's documents one after another, little-endian unsigned
  16-bit when the vocabulary fits, else 32-bit;
* ``<shard>.off``  ``n_docs + 1`` little-endian unsigned 64-bit offsets, counted in ids from
  the start of the whole corpus: document i holds ids ``off[i] .. off[i+1]``;
* ``<shard>.doc``  the document ids (8 bytes each) and a validity byte each.

Shards are key ranges of the document id, so shard order is document order. Each shard is
written by one task that streams its documents; its base is the prefix sum of the id counts
of the shards before it (one small row per shard, never one per document).

Cases: null or empty text gives the end id alone; a null document id sorts first; repeated
ids keep all their rows, ordered by text; an empty table gives no rows; other columns are
ignored. A document longer than a batch is encoded line by line, never cut.
"""
from __future__ import annotations

import itertools
import operator
import os
import re
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.llm import files
from tickerlens.llm.tables import lean
from tickerlens.session import ensure_shipped, scratch_path

CACHE_WORDS = 400_000  # pieces and runs whose ids a worker remembers; the older half goes when full
ENCODE_CHARS = 200_000  # new pieces are encoded in joins of about this length
# Characters below U+0100 as the pre-tokenizer classes them (white space is never asked for).
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LATIN = re.compile("[ !-~\u00a1-\u00ff]+")
_WORD = re.compile(f" ?[{_LETTERS}]+")
_TOKENS = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^ {_LETTERS}{_NUMBERS}]+")
_ID = operator.attrgetter("id")
DOC_DTYPE = np.dtype([("id", "<i8"), ("valid", "u1")])


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others for the next letters after U+00FF."""
    itself = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    later = itertools.count(0x100)
    return "".join(chr(b) if b in itself else chr(next(later)) for b in range(256))


class _Known(dict):
    """Ids of pieces; an unknown one is asked of ``encode`` and remembered."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.encode(word)
        return ids


class PieceEncoder:
    """Encodes whole texts with a ``tokenizers`` byte-level BPE, remembering pieces.

    The pre-tokenizer of byte-level BPE always starts a token at a space that stands between
    two other non-space characters, and around a lone line break. Cutting there gives pieces
    whose ids, joined, are the ids of the whole text, so a piece seen before is not encoded
    again. Pieces of Latin characters are cut further, into the runs of letters, numbers and
    marks that the pre-tokenizer tells apart, and each new run goes to the library's model,
    which only merges. Texts with other white space (runs, tabs, NUL, breaks at either end) are
    encoded as they are, by the library in one call.

    A text can't spell a control token, unless ``spell_control`` asks for the library's plain
    call: then a text that holds one's content is encoded in one call too.
    """

    def __init__(self, path: str, dtype: str, spell_control: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not spell_control
        self.control = [t.content for t in self.tok.get_added_tokens_decoder().values()] if spell_control else []
        # runs are merged by the model alone where nothing else has a say in them
        alone = (isinstance(self.tok.model, models.BPE) and isinstance(self.tok.pre_tokenizer, pre_tokenizers.ByteLevel)
                 and self.tok.normalizer is None and not self.tok.pre_tokenizer.add_prefix_space)
        self.model, self.letters = self.tok.model if alone else None, _byte_letters()
        self.dtype = np.dtype(dtype)
        brk = self.tok.encode("\n", add_special_tokens=False).ids
        self.brk = brk[0] if len(brk) == 1 else None
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.known = _Known(self.latin)  # and of runs: each is a piece with the same ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    @staticmethod
    def pieces(text: str) -> list[str] | None:
        """None if spaces or line breaks of the text don't stand alone; other white space is
        found in the pieces that hold it."""
        if "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n":
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _encode(self, words: list[str]) -> None:
        """Ids of words without white space inside, joined by line breaks so one call encodes many."""
        i = 0
        while i < len(words):
            j, size = i, 0
            while j < len(words) and size < ENCODE_CHARS:
                size += len(words[j]) + 1
                j += 1
            part = words[i:j]
            ids = np.array(self.tok.encode("\n".join(part), add_special_tokens=False).ids, dtype=self.dtype)
            cuts = np.flatnonzero(ids == self.brk)
            if len(cuts) == len(part) - 1:
                width, blob = self.dtype.itemsize, ids.tobytes()
                lo = [0, *((cuts + 1) * width).tolist()]
                hi = [*(cuts * width).tolist(), len(blob)]
                self.known.update((w, blob[a:b]) for w, a, b in zip(part, lo, hi))
            else:  # a word that itself holds the break's id
                self.known.update((w, self.whole(w)) for w in part)
            i = j

    def merged(self, run: str) -> bytes:
        """Ids of a run of Latin characters, from the model alone."""
        letters = charmap_decode(run.encode(), "strict", self.letters)[0]
        return array(self.code, map(_ID, self.model.tokenize(letters))).tobytes()

    def latin(self, word: str) -> bytes:
        """Ids of a word of Latin characters; KeyError for any other."""
        if self.model is None:
            raise KeyError(word)
        if _WORD.fullmatch(word):  # one run
            return self.merged(word)
        if not _LATIN.fullmatch(word):
            raise KeyError(word)
        known, ids = self.known, b""
        for run in _TOKENS.findall(word):
            got = known.get(run)
            if got is None:
                got = known[run] = self.merged(run)
            ids += got
        return ids

    def learn(self, new: set[str]) -> bool:
        """Remembers the ids of new pieces, unless one holds white space, which it can't."""
        if any(len(w.split()) != 1 for w in new):
            return False
        self._encode(sorted(new))
        return True

    def encoded(self, text: str) -> bytes:
        cut = None
        if text and self.brk is not None and not any(c in text for c in self.control):
            cut = self.pieces(text)
        if cut is None:
            return self.whole(text) if text else b""
        get = self.known.__getitem__
        try:
            return b"".join(map(get, cut))
        except KeyError:  # a piece that neither is known nor Latin
            other = {w for w in cut if w not in self.known and not (self.model is not None and _LATIN.fullmatch(w))}
            return b"".join(map(get, cut)) if self.learn(other) else self.whole(text)

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of the file's integer type."""
        if len(self.known) > CACHE_WORDS:
            for w in list(itertools.islice(self.known, len(self.known) // 2)):
                del self.known[w]
        self.known["\n"] = np.array([self.brk or 0], dtype=self.dtype).tobytes()
        return [self.encoded(t) for t in texts]


_ENCODERS: dict = {}


def encoder(path: str, dtype: str, spell_control: bool = False) -> PieceEncoder:
    """One encoder per Python worker, so pieces learned in one task serve the next."""
    key = path, dtype, spell_control
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(*key)
    return _ENCODERS[key]


def file_dtype(tokenizer_path: str, end_id: int) -> str:
    from tokenizers import Tokenizer
    top = max(Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values(), default=0)
    return "<u2" if max(top, end_id) < 1 << 16 else "<u4"


def _text_groups(batches: Iterator[pa.RecordBatch], max_chars: int = 1 << 20):
    """(ids, texts) of a few documents at a time."""
    for b in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(b.column(0), b.column(1)):
            ids.append(i.as_py())
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= max_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def write_store(docs: DataFrame, folder: str, tokenizer_path: str, *, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = 0, spell_control: bool = False) -> DataFrame:
    """Write ``docs`` to ``folder``; returns the shard table (shard, name, n_docs, n_ids, base)."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    dtype = file_dtype(tokenizer_path, end_id)
    files.make_dir(folder)

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, dtype, spell_control)
        end = np.array([end_id], dtype=dtype).tobytes()
        width = np.dtype(dtype).itemsize
        groups = _text_groups(batches)
        first = next(groups, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        name = files.unique(f"shard-{shard:06d}")
        fs, path = files.filesystem(f"{folder}/{name}")
        n_docs = n_ids = 0
        with fs.open_output_stream(path + ".bin") as bin_, fs.open_output_stream(path + ".len") as len_, \
                fs.open_output_stream(path + ".doc") as doc_:
            for ids, texts in itertools.chain([first], groups):
                blobs = [x + end for x in enc.batch(texts)]
                lens = np.array([len(x) // width for x in blobs], dtype="<u8")
                doc = np.zeros(len(ids), DOC_DTYPE)
                doc["id"] = [0 if i is None else i for i in ids]
                doc["valid"] = [i is not None for i in ids]
                bin_.write(b"".join(blobs))
                len_.write(lens.tobytes())
                doc_.write(doc.tobytes())
                n_docs += len(ids)
                n_ids += int(lens.sum())
        yield pa.RecordBatch.from_pydict({"shard": [shard], "name": [name], "n_docs": [n_docs], "n_ids": [n_ids]},
                                         schema=pa.schema([("shard", pa.int64()), ("name", pa.string()),
                                                           ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    ordered = rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    path = scratch_path(spark, "token-shards")
    schema = "shard long, name string, n_docs long, n_ids long"
    ordered.mapInArrow(lean(write_shard), schema).write.parquet(path)  # the files are written here, once
    shards = spark.read.schema(schema).parquet(path).orderBy("shard").collect()  # one row per shard
    bases = np.concatenate([[0], np.cumsum([r["n_ids"] for r in shards])]).astype("int64")
    based = spark.createDataFrame([(r["shard"], r["name"], r["n_docs"], r["n_ids"], int(b))
                                   for r, b in zip(shards, bases)], schema + ", base long")

    def write_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                lens = files.flat_array(f"{folder}/{r['name']}.len", "<u8")
                off = np.concatenate([[0], np.cumsum(lens, dtype="<u8")]).astype("<u8") + np.uint64(r["base"])
                files.write_bytes(f"{folder}/{r['name']}.off", off.tobytes())
            yield b

    done = scratch_path(spark, "token-offsets")
    based.mapInArrow(lean(write_offsets), based.schema).write.parquet(done)
    return spark.read.schema(based.schema).parquet(done)


def read_store(shards: DataFrame, folder: str, dtype: str, *, with_ids: bool = True,
               docs_per_task: int = 1 << 14) -> DataFrame:
    """Read the files back, memory-mapped, one row per document: doc_id, start, n_tokens,
    ids_crc32 and, unless ``with_ids`` is false, the ids."""
    spark = shards.sparkSession
    ensure_shipped(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                stem = f"{folder}/{r['name']}"
                ids, off = files.flat_array(stem + ".bin", dtype), files.flat_array(stem + ".off", "<u8")
                doc = files.flat_array(stem + ".doc", DOC_DTYPE)
                for lo in range(r["lo"], r["hi"], 512):
                    hi = min(lo + 512, r["hi"])
                    at = (off[lo:hi + 1] - np.uint64(r["base"])).astype("int64").tolist()
                    part = [np.asarray(ids[x:y]).astype("<u4") for x, y in zip(at, at[1:])]
                    d = np.asarray(doc[lo:hi])
                    cols = [pa.array(d["id"], mask=d["valid"] == 0), pa.array(off[lo:hi].astype("int64")),
                            pa.array(np.diff(at)), pa.array([zlib.crc32(p) for p in part], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([p.astype("int32") for p in part], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    spans = shards.select("name", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1,
                                                               F.lit(docs_per_task).cast("long"))).alias("lo"),
                          "n_docs").withColumn("hi", F.least(F.col("lo") + docs_per_task, F.col("n_docs")))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return spans.mapInArrow(lean(read), schema)


def token_digests(docs: DataFrame, tokenizer_path: str | None = None, **kw) -> DataFrame:
    """Write ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32 per document."""
    spark: SparkSession = docs.sparkSession
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "tokens")
    shards = write_store(docs, folder, tokenizer_path, **kw)
    return read_store(shards, folder, file_dtype(tokenizer_path, kw.get("end_id", 0)), with_ids=False)

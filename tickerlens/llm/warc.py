"""Operator 5: WARC archives written from and read back as a chunked record table.

A record's payload travels as rows (record, chunk number, bytes) of at most ``chunk_bytes``,
each with the SHA-256 of the payload so far, so neither the writer nor the reader ever holds
a whole record: the writer streams sorted chunk rows into one gzip member per record, the
reader streams members and hashes chunk by chunk. Only (page, digest, length) rows are
shuffled to find equal payloads.

Of the records with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest page id is a
``response``, the others are ``revisit`` records that name it; smaller payloads are always
responses.

Cases: a null payload is empty; a null url becomes ``urn:page:<id>``; a null page id is kept,
always a response, and never referred to; rows that repeat page id and payload keep one
record each, of the same type; an empty table gives no archive and no rows; other columns
are ignored.
"""
from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm import files
from tickerlens.session import ensure_shipped, scratch_path

CHUNK_BYTES = 1 << 18
ARCHIVE_BYTES = 1 << 30
BATCH_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the WARC standard

CHUNKS = ("page_id long, url string, rec string, chunk_no int, is_last boolean, data binary, "
          "running_sha256 string, payload_bytes long, payload_digest string")
KEYS = "page_id long, payload_bytes long, payload_digest string"
RECORDS = ("page_id long, record_type string, refers_to long, chunk_no int, is_last boolean, "
           "payload_bytes long, payload_digest string, running_sha256 string, data binary")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


class _Rows:
    """Collects rows and gives them out as record batches of bounded size."""

    def __init__(self, ddl: str):
        self.schema, self.rows, self.size = _schema(ddl), [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(cols, schema=self.schema)


def _chunks(payload: memoryview, chunk_bytes: int) -> Iterator[tuple[int, bool, memoryview]]:
    n = max(1, -(-len(payload) // chunk_bytes))
    for i in range(n):
        yield i, i == n - 1, payload[i * chunk_bytes:(i + 1) * chunk_bytes]


def _page_rows(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))


def payload_keys(pages: DataFrame, id_col: str, url_col: str, payload_col: str, chunk_bytes: int) -> DataFrame:
    """(page_id, payload_bytes, payload_digest) of each page, hashed chunk by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, digests = [], []
            for cell in b.column(1):
                payload, h = memoryview(cell.as_buffer()), hashlib.sha256()
                for _, _, part in _chunks(payload, chunk_bytes):
                    h.update(part)
                sizes.append(len(payload))
                digests.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             schema=_schema(KEYS))
    return _page_rows(pages, id_col, url_col, payload_col).select("page_id", "payload").mapInArrow(run, KEYS)


def chunk_table(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The payloads as chunk rows with running digests; ``rec`` names the input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part_id, n = _Rows(CHUNKS), TaskContext.get().partitionId(), 0
        for b in batches:
            for page, url, cell in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                payload, h, running = memoryview(cell.as_buffer()), hashlib.sha256(), []
                for _, _, part in _chunks(payload, chunk_bytes):
                    h.update(part)
                    running.append(h.hexdigest())
                for i, last, part in _chunks(payload, chunk_bytes):
                    yield from out.add((page, url if i == 0 else None, f"{part_id}-{n}", i, last, bytes(part), running[i],
                                        len(payload), running[-1]), len(part))
                n += 1
        yield from out.flush()
    return _page_rows(pages, id_col, url_col, payload_col).mapInArrow(run, CHUNKS)


def revisits(keys: DataFrame, revisit_bytes: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat an earlier page's payload.

    ``keys`` and the groups are stored tables, so the join on the digest is between two plain
    exchanges and Spark splits a digest that holds many pages."""
    spark = keys.sparkSession
    path = scratch_path(spark, "warc-first")
    (keys.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest", "payload_bytes")
     .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
     .write.parquet(path))
    first = spark.read.parquet(path)
    return (keys.join(first, ["payload_digest", "payload_bytes"]).where("page_id > refers_to")
            .select("page_id", "payload_digest", "refers_to").distinct())


def _record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def _head(page, url, digest: str, size: int, refers_to, date: str) -> bytes:
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page, digest)}",
             f"WARC-Target-URI: {quote(url, safe=chr(37) + '/:?#[]@!$&()*+,;=~') if url else f'urn:page:{page}'}",
             f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {size}"]
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", chunk_bytes: int = CHUNK_BYTES, revisit_bytes: int = 100,
                   archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per page into ``.warc.gz`` files; returns (name, n_records)."""
    spark = pages.sparkSession
    ensure_shipped(spark)
    files.make_dir(folder)
    path = scratch_path(spark, "warc-keys")
    payload_keys(pages, id_col, url_col, payload_col, chunk_bytes).write.parquet(path)
    refers = revisits(spark.read.parquet(path), revisit_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = gz = name = None
        n, done = 0, []
        for b in batches:
            for page, url, no, last, data, size, digest, ref in zip(
                    *(b.column(c).to_pylist() for c in ("page_id", "url", "chunk_no", "is_last")), b.column("data"),
                    *(b.column(c).to_pylist() for c in ("payload_bytes", "payload_digest", "refers_to"))):
                if no == 0:  # a record begins; a full archive ends before it
                    if out is not None and out.tell() >= archive_bytes:
                        out.close()
                        done.append((name, n))
                        out = None
                    if out is None:
                        name, n = files.unique(f"part-{TaskContext.get().partitionId():06d}") + ".warc.gz", 0
                        fs, p = files.filesystem(f"{folder}/{name}")
                        out = fs.open_output_stream(p, compression=None)
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(gz.compress(_head(page, url, digest, size, ref, date)))
                    n += 1
                if ref is None and size:
                    out.write(gz.compress(data.as_buffer()))
                if last:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if out is not None:
            out.close()
            done.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         names=["name", "n_records"])

    chunks = chunk_table(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, chunk_bytes=chunk_bytes)
    # the chunks of a record come from one map task, so they stay together however Spark splits the join
    rows = (chunks.join(refers, ["page_id", "payload_digest"], "left").select("page_id", "url", "rec", "chunk_no", "is_last", "data",
                                                                              "payload_bytes", "payload_digest", "refers_to")
            .sortWithinPartitions("page_id", "rec", "chunk_no"))
    listed = scratch_path(spark, "warc-files")
    rows.mapInArrow(write, "name string, n_records long").write.parquet(listed)
    return spark.read.schema("name string, n_records long").parquet(listed)


def _headers(f) -> dict[str, str] | None:
    first = f.readline()
    if not first:
        return None
    out = {}
    while (line := f.readline().strip()):
        k, _, v = line.decode().partition(":")
        out[k.lower()] = v.strip()
    return out


def read_chunks(archives: DataFrame, folder: str, *, with_data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archives as chunk rows; without data only each record's last row is given, whose
    running digest and length cover the whole payload. A revisit has its one row's digest and
    length from its header, which are those of the full payload."""
    ensure_shipped(archives.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(RECORDS)
        for name in (x for b in batches for x in b.column(0).to_pylist()):
            fs, p = files.filesystem(f"{folder}/{name}")
            with fs.open_input_stream(p, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
                while (head := _headers(f)) is not None:
                    left = int(head["content-length"])
                    kind, page = head["warc-type"], int(head["page-id"]) if "page-id" in head else None
                    ref = int(head["refers-to-page-id"]) if "refers-to-page-id" in head else None
                    while (line := f.readline()) not in (b"\r\n", b""):
                        left -= len(line)
                    left -= 2
                    if kind == "revisit":
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        yield from out.add((page, kind, ref, 0, True, int(head["payload-length"]), digest, digest, None), 0)
                    else:
                        h, no, size = hashlib.sha256(), 0, 0
                        while True:
                            part = f.read(min(left, chunk_bytes))
                            h.update(part)
                            left -= len(part)
                            size += len(part)
                            last = left <= 0
                            if with_data or last:
                                yield from out.add((page, kind, ref, no, last, size, h.hexdigest() if last else None, h.hexdigest(),
                                                    part if with_data else None), len(part))
                            if last:
                                break
                            if not part:
                                raise EOFError(f"{name}: record of page {page} is cut off")
                            no += 1
                    f.read(4)
        yield from out.flush()
    return archives.select("name").mapInArrow(read, RECORDS)


def record_digests(pages: DataFrame, **kw) -> DataFrame:
    """Write ``pages`` as archives, read them back: one row per page."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    archives = write_archives(pages, folder, **kw)
    return (read_chunks(archives, folder, with_data=False).where("is_last")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))

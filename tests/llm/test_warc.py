import gzip
import hashlib

from pyarrow import fs as pafs

from tickerlens.llm import warc
from tickerlens.session import scratch_path

BIG = "<p>é" + "x" * 300_000
ROWS = [(1, "http://a/", "y" * 100), (2, "http://b/?q=1\r\nX", "y" * 100), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
        (7, "u", BIG), (0, "u", BIG), (7, "u", BIG), (9, "u", "z" * 99), (8, "u", "z" * 99), (None, "u", "y" * 100), (2, "v", "other " * 40)]


def brute(rows):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and i is not None and first[h] < i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, rec string").repartition(3)


def test_records_equal_brute_force(spark):
    got = warc.record_digests(pages(spark, ROWS), chunk_bytes=1000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_chunks_round_trip_and_archives_roll(spark):
    folder = scratch_path(spark, "w")
    names = warc.write_archives(pages(spark, ROWS), folder, chunk_bytes=4096, archive_bytes=1)
    assert names.count() > 3 and names.agg({"n_records": "sum"}).first()[0] == len(ROWS)
    chunks = warc.read_chunks(names, folder, chunk_bytes=5000).collect()
    assert all(len(c.data) <= 5000 for c in chunks if c.data is not None)
    parts = sorted((c for c in chunks if c.page_id == 0), key=lambda c: c.chunk_no)
    assert b"".join(bytes(c.data) for c in parts) == BIG.encode()
    h = hashlib.sha256()
    for c in parts:  # each row carries the digest so far
        h.update(bytes(c.data))
        assert c.running_sha256 == h.hexdigest()
    assert [c.is_last for c in parts] == [False] * (len(parts) - 1) + [True]


def test_records_are_wellformed(spark):
    folder = scratch_path(spark, "w")
    name = warc.write_archives(pages(spark, ROWS[:2]).coalesce(1), folder).first()["name"]
    fs, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
    with fs.open_input_stream(path, compression=None) as raw:
        data = gzip.decompress(raw.read())
    assert data.startswith(b"WARC/1.1\r\n")
    for line in (b"WARC-Record-ID: <urn:uuid:", b"WARC-Date: ", b"Content-Length: "):
        assert line in data
    assert b"\r\nX" not in data  # an address cannot add header lines


def test_empty_table(spark):
    assert warc.record_digests(pages(spark, ROWS).limit(0)).count() == 0

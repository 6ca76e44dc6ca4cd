"""Files in the shared folder, opened from executors through pyarrow's filesystems."""
from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """(filesystem, path) of an absolute path or URI (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri)


def unique(prefix: str) -> str:
    """A name no other task attempt uses; only committed attempts are listed in a manifest."""
    return f"{prefix}-{uuid.uuid4().hex[:12]}"


def make_dir(uri: str) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path, recursive=True)


def write_bytes(uri: str, data: bytes) -> None:
    fs, path = filesystem(uri)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)


def flat_array(uri: str, dtype: str) -> np.ndarray:
    """A flat binary file as an array: memory-mapped where the shared folder is mounted
    (pages are read on demand and never held whole), else read from the store."""
    fs, path = filesystem(uri)
    size = fs.get_file_info(path).size
    if not size:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(size), dtype=dtype)

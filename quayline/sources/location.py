"""Paths and URIs to Arrow file systems."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs

# What Arrow opens, and Hadoop's names for the same stores.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def open_location(location: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it.  ``file:/a`` equals ``file:///a``, and
    so does ``name:///a``."""
    local = re.match(r"file:/+(.*)", location)
    if local:
        return fs.LocalFileSystem(), f"/{local.group(1)}".rstrip("/") or "/"
    named = re.match(r"name:/+(.*)", location)
    if named:
        return fs.LocalFileSystem(), f"/{named.group(1)}".rstrip("/") or "/"
    scheme = location.partition("://")[0]
    if "://" in location and scheme not in SCHEMES:
        raise ValueError(f"unsupported scheme {scheme!r}: one of {', '.join(SCHEMES)}")
    if "://" in location:
        # Hadoop's names for the same stores.
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", location))
    return fs.LocalFileSystem(), location.rstrip("/") or "/"


def read_bytes(location: str) -> bytes:
    """The whole of a small file, such as a key, wherever it is."""
    files, path = open_location(location)
    with files.open_input_stream(path, compression=None) as source:
        return source.read()


@contextmanager
def as_file(location: str | None) -> Iterator[str | None]:
    """A path for libraries that read keys from local files only: ``location`` itself if it is a
    path, else a private copy that goes with the block."""
    if location is None or "://" not in location:
        yield location
        return
    handle, path = tempfile.mkstemp(prefix="key-")
    try:
        with os.fdopen(handle, "wb") as out:
            out.write(read_bytes(location))
        yield path
    finally:
        os.unlink(path)

"""Binary files in the shared folder, by whatever file system its address names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address such as file:///x, hdfs://... or a plain path."""
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    # Spark's names of one and the same store.
    for name in ("s3a://", "s3n://"):
        if uri.startswith(name):
            uri = "s3://" + uri.removeprefix(name)
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_file(uri: str, chunks: Iterable[bytes]) -> int:
    """Write a file under another name and move it into place: a repeated task replaces it whole."""
    system, path = resolve(uri)
    parent, _, name = path.rpartition("/")
    system.create_dir(parent, recursive=True)
    part = f"{parent}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    system.move(part, path)
    return size


def open_stream(uri: str) -> pa.NativeFile:
    """A file as a stream of its bytes, as they are."""
    system, path = resolve(uri)
    return system.open_input_stream(path, compression=None)


def read_range(uri: str, begin: int, size: int) -> bytes:
    system, path = resolve(uri)
    with system.open_input_file(path) as source:
        return source.read_at(size, begin)


def sizes(uri: str, suffix: str) -> list[tuple[str, int]]:
    """Addresses and bytes of the files in a folder, as Spark lists a table's files."""
    system, path = resolve(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((f"{uri}/{x.base_name}", x.size) for x in found if x.base_name.endswith(suffix) and not x.base_name.startswith("."))

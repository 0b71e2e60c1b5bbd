"""Files in the shared folder that tasks write and read themselves.

Paths are URIs of any file system that Arrow knows. A file appears under its name in one step, so a task
that is run again, or twice, leaves one whole file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str) -> Iterator[pa.NativeFile]:
    """A stream into a new file that gets its name when all is written."""
    store, path = locate(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt, compression=None) as stream:
        yield stream
    store.move(attempt, path)


def read_part(folder: str, name: str, value: int, columns: list[str]) -> pa.Table | None:
    """The rows that ``partitionBy(name)`` wrote for one value, or ``None``."""
    store, path = locate(f"{folder}/{name}={value}")
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
    tables = [pq.read_table(f, columns=columns, filesystem=store, partitioning=None) for f in files]
    return pa.concat_tables(tables) if tables else None

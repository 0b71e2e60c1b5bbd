"""Intermediate tables in the shared folder: they cut the lineage and outlive lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from clickloom.session import shared_dir


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or path, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def remove(folder: str) -> None:
    """Delete a folder of ours, if it is there."""
    store, path = store_of(folder)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


def saved(df: DataFrame, folder: str, partition: str | None = None, codec: str | None = None) -> DataFrame:
    """``df`` written to ``folder`` and read again, with its own schema."""
    (df.write.partitionBy(partition) if partition else df.write).parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_folder(folder: str, columns: list[str]) -> pa.Table | None:
    """A saved table, or one value of its partition column, read by a task itself; ``None`` if it is not there."""
    store, path = store_of(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = sorted(f.path for f in found if f.base_name.endswith(".parquet"))
    tables = [pq.read_table(f, columns=columns, filesystem=store, partitioning=None) for f in files]
    return pa.concat_tables(tables) if tables else None


_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the job that wrote them ends, not when the driver next collects garbage."""
    before = spark.conf.get(_FREES, None)
    spark.conf.set(_FREES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREES) if before is None else spark.conf.set(_FREES, before)


class Scratch:
    """Numbered tables below one folder of a job."""

    def __init__(self, df: DataFrame, purpose: str) -> None:
        self.folder, self.count = shared_dir(df.sparkSession, purpose), 0

    def saved(self, df: DataFrame, partition: str | None = None, codec: str | None = None) -> DataFrame:
        self.count += 1
        return saved(df, f"{self.folder}/{self.count}", partition, codec)

    def drop_before(self, keep: int) -> None:
        """Delete all but the last ``keep`` tables."""
        for n in range(1, self.count - keep + 1):
            remove(f"{self.folder}/{n}")


@contextmanager
def scratch(df: DataFrame, purpose: str) -> Iterator[Scratch]:
    """A folder for the tables of one job that goes when the job ends."""
    own = Scratch(df, purpose)
    try:
        yield own
    finally:
        remove(own.folder)

"""Filters, null replacement, set operations and layout."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import conform, quoted


def of_type(events: DataFrame, event_type: str, column: str = "event_type") -> DataFrame:
    """Events of one type."""
    return events.filter(F.col(column) == event_type)


def without_tombstones(records: DataFrame, value: str = "value") -> DataFrame:
    """Topic records that carry a value."""
    return records.filter(F.col(value).isNotNull())


def fill_measures(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Null measures become 0; keys keep their nulls."""
    return df.na.fill(0, subset=list(measures))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by their literal names, brackets and all."""
    return df.withColumnsRenamed(dict(names))


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns by their literal names, in this order."""
    return df.select(*[quoted(name) for name in names])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed. Copies already collapse before the shuffle."""
    return df.dropDuplicates()


def rows_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; nulls equal each other.

    Both sides lose their copies before the join, so that many copies of one row do not meet in
    one task.
    """
    return left.distinct().subtract(right.distinct())


def stack(schema: T.StructType, *frames: DataFrame) -> DataFrame:
    """Union by name after each frame has been given the declared schema."""
    first, *rest = [conform(frame, schema) for frame in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def by_hash(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows of one key together in ``partitions`` parts.

    Without a number the layout is a request: Spark then splits a key that holds too many rows and
    merges small parts.
    """
    columns = [F.col(key) for key in keys]
    if partitions is None:
        return df.hint("rebalance", *columns)
    return df.repartition(partitions, *columns)


def evenly(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows spread evenly, whatever their keys."""
    return df.hint("rebalance") if partitions is None else df.repartition(partitions)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` while the block runs. Use it only for a frame read by two or more actions."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()

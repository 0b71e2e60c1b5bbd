"""Tables behind a connector, such as document collections.

The connector is a name and options from the caller; any format Spark knows will do.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def collection_options(
    uri: str,
    database: str,
    collection: str,
    partitioner: str | None = None,
    partition_key: str | None = None,
    infer_schema: bool = False,
) -> dict[str, str]:
    """Options of a document collection, for reading and writing."""
    options = {"uri": uri, "database": database, "collection": collection}
    if partitioner:
        options["partitioner"] = partitioner
    if partition_key:
        options["partitionKey"] = partition_key
    if infer_schema:
        options["inferSchema"] = "true"
    return options


def read_table(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A table read by its connector, reduced to ``columns`` right away."""
    df = spark.read.format(fmt).options(**(options or {})).load()
    return df.select(*columns) if columns else df


def unless_empty(df: DataFrame, what: str) -> DataFrame | None:
    """The frame, or ``None`` with a warning when it has no row."""
    if df.isEmpty():
        log.warning("%s is empty", what)
        return None
    return df


def write_table(
    df: DataFrame, fmt: str, options: Mapping[str, str] | None = None, mode: str = "append"
) -> None:
    """Write by a connector."""
    df.write.format(fmt).options(**(options or {})).mode(mode).save()


def store_layout(df: DataFrame, name: str, folder: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table laid out once for all later reads: in buckets by ``keys``, each bucket sorted by them.

    Joins with a table of equal buckets by these keys, and groupings that contain them, need no exchange. The
    table is known to the session's catalogue as ``name`` and lies in ``folder``. Each bucket is one file for a task that writes
    it, so rows are brought together first.
    """
    first, *rest = keys
    spread = df.repartition(buckets, *keys)
    writer = spread.write.bucketBy(buckets, first, *rest).sortBy(first, *rest)
    writer.option("path", folder).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)

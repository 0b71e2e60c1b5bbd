"""Intermediate tables of a job, in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.shared import locate
from clickloom.session import shared_dir

# While a stage is written: its shuffle files go when it ends, because what it wrote is all that is needed
# later, and texts reach Python in batches of a few megabytes.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextmanager
def _stage_settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Tables whose rows are few and narrow go into files of so many.
ROWS_PER_FILE = 200_000


def written(df: DataFrame, purpose: str, partition: str | None = None, rows: int | None = None) -> tuple[DataFrame, str]:
    """``df`` as a table of the shared folder: read again, and its folder.

    This cuts the lineage, survives lost executors and frees the shuffles that led to it. If ``df`` is known to
    have at most ``rows`` narrow rows, it is written in as many files as they fill, not one for each task.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    folder = shared_dir(spark, purpose)
    with _stage_settings(spark):
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def wrapped(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that none can clash with columns beside it."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in df.columns]).alias("row")


def dropped(folder: str) -> None:
    """Remove a table that :func:`written` made and that nothing will read again."""
    store, path = locate(folder)
    store.delete_dir(path)


def whole_keys(df: DataFrame, key: str) -> None:
    """Refuse a key column that does not hold whole numbers, before any job starts."""
    kind = df.schema[key].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"keys are whole numbers, but {key} is {kind}")

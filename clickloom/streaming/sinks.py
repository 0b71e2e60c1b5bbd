"""Micro-batch sinks that may be repeated.

After a failure Spark runs the last micro-batch again under the same number. Each batch has a
folder of its own, which the repetition overwrites, so every batch counts once. A folder belongs to
one checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.vectors import DIMENSION
from clickloom.sources.tables import write_table
from clickloom.sources.vector_sink import write_points

BatchSink = Callable[[DataFrame, int], None]

BATCH = "batch_id"


def batch_folder(path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> BatchSink:
    """A sink that writes each batch to ``path/batch_id=<n>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{path}/{BATCH}={batch_id}")

    return write


def table_connector(fmt: str, options: Mapping[str, str]) -> BatchSink:
    """A sink that appends each batch by a connector, such as a document collection.

    A repeated batch is appended again, unless the store replaces rows by a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, fmt, options, "append")

    return write


def point_connector(
    fmt: str, options: Mapping[str, str], vector: str = "vector", dimension: int = DIMENSION
) -> BatchSink:
    """A sink that sends each batch of points to a store, which replaces points by their id.

    A repeated batch sends the same ids again and so changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_points(batch, fmt, options, "append", vector, dimension)

    return write


def read_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All batches of a sink, with their ``batch_id``; no rows if there is none yet."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.format(fmt).options(**(options or {})).schema(full).load(path)


def latest_per(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in the given order.

    Spark keeps only the first row of each key per task before it shuffles, so that a key with very
    many copies does not fill one task.
    """
    newest = Window.partitionBy(key).orderBy(*[F.desc(name) for name in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


# Beside the batches of a sink: the points of all batches up to the number in a folder's name.
_COMPACTED, _UP_TO = "_compacted", "upto="


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _file_system(spark, path)
    return system.exists(hadoop)


def _numbers(spark: SparkSession, path: str, prefix: str, done: str = "") -> list[int]:
    """The numbers of the folders ``path/<prefix><n>`` that hold a file named ``done``, ascending."""
    pattern, system = _file_system(spark, f"{path}/{prefix}*{'/' + done if done else ''}")
    found = [status.getPath() for status in system.globStatus(pattern) or []]
    return sorted(int((p.getParent() if done else p).getName().removeprefix(prefix)) for p in found)


def _points_since(spark: SparkSession, path: str, schema: T.StructType, last: int | None = None) -> DataFrame:
    """The newest compacted points with all later batches up to ``last``, with their batch."""
    upto = _numbers(spark, path + _COMPACTED, _UP_TO, "_SUCCESS")
    batches = read_batches(spark, path, schema)
    if upto:
        batches = batches.filter(F.col(BATCH) > upto[-1])
    if last is not None:
        batches = batches.filter(F.col(BATCH) <= last)
    if not upto:
        return batches
    before = spark.read.schema(schema).parquet(f"{path}{_COMPACTED}/{_UP_TO}{upto[-1]}")
    return before.withColumn(BATCH, F.lit(upto[-1]).cast("long")).unionByName(batches)


def compact_points(spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """Write the points of all batches but the newest once, and remove those batches; the last number.

    The newest batch may still be repeated, so it stays as it is. A reader sees either the batches or the
    compacted points: these count as soon as they are whole, and only then the batches go. An interrupted run
    is made good by the next one.
    """
    batches = _numbers(spark, path, f"{BATCH}=", "_SUCCESS")
    upto = _numbers(spark, path + _COMPACTED, _UP_TO, "_SUCCESS")
    if len(batches) > 1 and (not upto or batches[-2] > upto[-1]):
        last = batches[-2]
        points = latest_per(_points_since(spark, path, schema, last), "point_id", [BATCH]).drop(BATCH)
        points.write.mode("overwrite").parquet(f"{path}{_COMPACTED}/{_UP_TO}{last}")
        upto.append(last)
    if not upto:
        return None
    gone = [f"{path}/{BATCH}={n}" for n in batches if n <= upto[-1]]
    for folder in [*gone, *(f"{path}{_COMPACTED}/{_UP_TO}{n}" for n in upto[:-1])]:
        hadoop, system = _file_system(spark, folder)
        system.delete(hadoop, True)
    return upto[-1]


def read_points(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The points of an upsert sink: for each id the row of the newest batch.

    Every read ranks the points of all batches since the last :func:`compact_points`. A store that replaces
    points by their id (:func:`point_connector`) needs neither; it is what real use should have.
    """
    return latest_per(_points_since(spark, path, schema), "point_id", [BATCH]).drop(BATCH)

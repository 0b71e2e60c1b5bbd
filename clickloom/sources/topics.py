"""Message topics: reading, parsing, counting, writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.rows import without_tombstones
from clickloom.schemas import BEHAVIOR, CORRUPT, with_corrupt

FORMAT = "kafka"


def topic_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options for reading a topic, in batch or as a stream."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, options: Mapping[str, str], fmt: str = FORMAT) -> DataFrame:
    """All records of a topic from the start to the offsets that are latest now."""
    return spark.read.format(fmt).options(**options).load()


def stream_topic(spark: SparkSession, options: Mapping[str, str], fmt: str = FORMAT) -> DataFrame:
    """The endless record stream of a topic. Progress lives in the query's checkpoint."""
    return spark.readStream.format(fmt).options(**options).load()


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files that arrive in a folder, one record per line in ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parsed(value: str, schema: T.StructType) -> Column:
    """The JSON text of ``value`` as a struct; ``_corrupt_record`` in it is set where it does not fit."""
    return F.from_json(
        F.col(value).cast("string"),
        with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def tag_records(
    records: DataFrame, schema: T.StructType = BEHAVIOR, value: str = "value"
) -> DataFrame:
    """Records that carry a value, with the parsed struct ``_data`` and the flag ``_broken``.

    Records without a value are tombstones and are left out.
    """
    # Exploding one struct makes it a column that filters read; a plain expression would be pushed
    # into each filter and parse the text again there.
    data = F.explode(F.array(parsed(value, schema))).alias("_data")
    alive = without_tombstones(records, value).select("*", data)
    broken = F.col("_data").isNull() | F.col(f"_data.{CORRUPT}").isNotNull()
    return alive.withColumn("_broken", broken)


def split_records(
    tagged: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Parsed records, and dead letters with their raw ``value``.

    ``keep`` names record columns, such as the offset, to keep beside the fields.
    """
    good = tagged.filter(~F.col("_broken")).select("_data.*", *keep).drop(CORRUPT)
    dead = tagged.filter("_broken").select(F.col(value).cast("string").alias("value"), *keep)
    return good, dead


def parse_records(
    records: DataFrame, schema: T.StructType = BEHAVIOR, value: str = "value", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """:func:`tag_records` and :func:`split_records` in one step."""
    return split_records(tag_records(records, schema, value), value, keep)


def encode_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as JSON text in one column; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])).alias(value))


def write_topic(df: DataFrame, options: Mapping[str, str], fmt: str = FORMAT) -> None:
    """Append the ``value`` column to a topic."""
    df.write.format(fmt).options(**options).mode("append").save()


def partition_counts(records: DataFrame) -> DataFrame:
    """Earliest and next offset of each partition and the number of messages between them.

    Partitions belong to their topic where the records have one.
    """
    return (
        records.groupBy(*_topic(records), "partition")
        .agg(F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest"))
        .withColumn("messages", F.col("latest") - F.col("earliest"))
    )


def _topic(records: DataFrame) -> list[str]:
    return ["topic"] if "topic" in records.columns else []


def message_count(records: DataFrame, topic: str | None = None) -> DataFrame:
    """One row: the messages of one topic, or of all records; -1 where there are none.

    Records cannot tell an empty topic from one that does not exist: both give -1.
    """
    if topic is not None:
        records = records.filter(F.col("topic") == topic)
    return partition_counts(records).agg(F.coalesce(F.sum("messages"), F.lit(-1)).alias("messages"))


def topic_counts(records: DataFrame) -> DataFrame:
    """The messages of each topic."""
    return partition_counts(records).groupBy("topic").agg(F.sum("messages").alias("messages"))

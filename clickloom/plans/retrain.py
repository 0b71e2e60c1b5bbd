"""The event that tells the trainer that new vectors are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the event name the trainer listens to.
DATA_READY = "data_ready"
DEFAULT_MESSAGE = "New vectors are loaded. The model should be retrained."


def retrain_event(spark: SparkSession, n_points: int, message: str = DEFAULT_MESSAGE) -> DataFrame:
    """One row ``event, timestamp, message, n_points`` after a load of so many points."""
    return spark.range(1).select(
        F.lit(DATA_READY).alias("event"),
        F.unix_timestamp().alias("timestamp"),
        F.lit(message).alias("message"),
        F.lit(n_points).cast("bigint").alias("n_points"),
    )


def as_topic_value(event: DataFrame) -> DataFrame:
    """The event as JSON in ``value``; the row count stays out of the message."""
    return event.select(F.to_json(F.struct("event", "timestamp", "message")).alias("value"))

"""Topic records to vector points, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.embedders import Embedder, HashingEmbedder
from clickloom.functions.scalars import event_text, point_id
from clickloom.functions.text import tokenize
from clickloom.operators.rows import persisted
from clickloom.plans.vectors import once_per_text
from clickloom.sources.topics import split_records, tag_records
from clickloom.streaming.sinks import BatchSink, latest_per

# Fixed value: the payload of an online point, as it comes in the message.
PAYLOAD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ["user_session", "user_id", "product_id", "name", "event_type", "event_time"]
    ]
)

# The business key; the product's name is not part of it.
POINT_KEY = ["user_session", "user_id", "product_id", "event_type", "event_time"]

POINT = T.StructType(
    [
        T.StructField("point_id", T.StringType()),
        *PAYLOAD.fields,
        T.StructField("vector", T.ArrayType(T.FloatType())),
    ]
)

POSITION = ["timestamp", "partition", "offset"]


def event_points(events: DataFrame, embedder: Embedder | None = None, order: list[str] | None = None) -> DataFrame:
    """One point per event: id, payload and the vector of ``name event_type``.

    Repeated events have one id and give one point, the last one in ``order``.
    """
    keyed = events.withColumn("point_id", point_id(*POINT_KEY))
    # Without a position, copies differ in the name at most.
    unique = latest_per(keyed, "point_id", [*(order or []), "name"]).withColumn("_text", event_text())
    embedder = embedder or HashingEmbedder()

    def embed(rows: DataFrame, text: str, out: str) -> DataFrame:
        return embedder.embed(tokenize(rows, text, "_words"), "_words", out).drop("_words")

    embedded = once_per_text(unique, "_text", "vector", embed) if embedder.costly else embed(unique, "_text", "vector")
    return embedded.select(*POINT.fieldNames())


def upsert_batch(
    records: DataFrame, points: BatchSink, dead: BatchSink, batch_id: int = 0, embedder: Embedder | None = None
) -> None:
    """Turn one bounded set of records into points and dead letters."""
    upsert_tagged(tag_records(records, PAYLOAD), points, dead, batch_id, embedder)


def upsert_tagged(
    tagged: DataFrame, points: BatchSink, dead: BatchSink, batch_id: int = 0, embedder: Embedder | None = None
) -> None:
    """The same for records that are parsed already."""
    position = [name for name in POSITION if name in tagged.columns]
    with persisted(tagged) as tagged:
        good, broken = split_records(tagged, keep=position)
        points(event_points(good, embedder, position), batch_id)
        letters = broken.select(F.col("value"))
        if not letters.isEmpty():
            dead(letters, batch_id)


def first_seen(records: DataFrame, horizon: str) -> DataFrame:
    """Parsed records, each point's first one only, in whatever batches the others come.

    The ids that were seen are keyed state, which forgets an id ``horizon`` after it came: time is that of
    arrival, so nothing is ever too late, and a repetition after the horizon is a point again, of the same id. Broken
    records are told apart by their text and position.
    """
    tagged = tag_records(records, PAYLOAD)
    position = [name for name in POSITION if name in records.columns]
    known = point_id(*[f"_data.{name}" for name in POINT_KEY])
    unknown = point_id("value", *position)
    seen = tagged.withColumns({"_seen": F.when(F.col("_broken"), unknown).otherwise(known), "_arrived": F.current_timestamp()})
    return seen.withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["_seen"]).drop("_seen", "_arrived")


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, not on the heap, and write only its changes."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def upsert_stream(
    records: DataFrame,
    points: BatchSink,
    dead: BatchSink,
    checkpoint: str,
    embedder: Embedder | None = None,
    until_now: bool = False,
    interval: str = "1 second",
    horizon: str | None = None,
) -> StreamingQuery:
    """Keep the points up to date with a record stream.

    A malformed record goes to the dead letters and never stops the query. With a ``horizon``, such as ``1 day``, a
    point that was written is not written again within that time: see :func:`first_seen`.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_tagged(batch, points, dead, batch_id, embedder)

    tagged = tag_records(records, PAYLOAD) if horizon is None else first_seen(records, horizon)
    writer = tagged.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if until_now else writer.trigger(processingTime=interval)
    with state_on_disk(records.sparkSession) if horizon else nullcontext():
        return writer.start()

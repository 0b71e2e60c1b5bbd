"""Writing vector points: by a connector, to Parquet, or through a client in batches."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from clickloom.functions.vectors import DIMENSION, METRIC, enforce_contract

# Fixed value: points per request of a batch load.
BATCH_SIZE = 10_000


def collection_config(dimension: int = DIMENSION) -> dict[str, object]:
    """What a new collection is created with."""
    return {"size": dimension, "distance": METRIC}


def point_options(
    df: DataFrame,
    url: str,
    collection: str,
    vector: str = "vector",
    batch_size: int | None = None,
) -> dict[str, str]:
    """Options a vector store connector takes; the schema goes along as JSON."""
    options = {
        "url": url,
        "collection_name": collection,
        "embedding_field": vector,
        "schema": df.schema.json(),
    }
    if batch_size is not None:
        options["batch.size"] = str(batch_size)
    return options


def write_points(
    df: DataFrame,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    mode: str = "append",
    vector: str = "vector",
    dimension: int = DIMENSION,
) -> int:
    """Write points whose vectors all keep the contract, and return their number.

    The write fails at a vector that breaks the contract. ``mode="overwrite"`` recreates the
    collection. The points are counted as they pass, without another job.
    """
    counted = Observation()
    checked = enforce_contract(df, vector, dimension).observe(counted, F.count("*").alias("n"))
    checked.write.format(fmt).options(**(options or {})).mode(mode).save()
    return counted.get["n"]


@dataclass
class Written(WriterCommitMessage):
    points: int


class PointWriter(DataSourceArrowWriter):
    """Sends the rows of each task to the store, a batch per request."""

    def __init__(self, options: Mapping[str, str], overwrite: bool) -> None:
        self.client = options["client"]
        self.collection = options["collection_name"]
        self.vector = options.get("embedding_field", "vector")
        self.id = options.get("id_field", "point_id")
        self.batch_size = int(options.get("batch.size", BATCH_SIZE))
        self.options = dict(options)
        self.target = self.collection
        if overwrite:
            # The old collection stays until all points of the new one are in.
            self.target = f"{self.collection}-{uuid.uuid4().hex}"
            dimension = int(options.get("dimension", DIMENSION))
            self.connect().recreate_collection(self.target, collection_config(dimension))

    def connect(self):
        module, _, factory = self.client.partition(":")
        return getattr(importlib.import_module(module), factory)(self.options)

    def point(self, payload: dict[str, object]) -> tuple[object, list[float], dict[str, object]]:
        return payload.pop(self.id), payload.pop(self.vector), payload

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        client, points = self.connect(), 0
        # A request may need the rows of several batches, or part of one.
        request: list = []
        for batch in iterator:
            for row in batch.to_pylist():
                request.append(self.point(row))
                if len(request) == self.batch_size:
                    client.upsert(self.target, request)
                    points += len(request)
                    request = []
        if request:
            client.upsert(self.target, request)
        return Written(points + len(request))

    def commit(self, messages: list[Written | None]) -> None:
        """A new collection takes the old one's place; added points count already."""
        if self.target != self.collection:
            self.connect().replace_collection(self.collection, self.target)

    def abort(self, messages: list[Written | None]) -> None:
        """A new collection goes, the old one stays; added points are replaced by the next load."""
        if self.target != self.collection:
            self.connect().drop_collection(self.target)


class ClientPoints(DataSource):
    """Format ``client_points``, for vector stores with a Python client only.

    Option ``client`` names a factory as ``module:function``. It is given the options and returns an
    object with ``upsert(collection, points)`` and, for loads that replace a collection,
    ``recreate_collection(collection, config)``, ``replace_collection(collection, by)`` and
    ``drop_collection(collection)``. A point is ``(id, vector, payload)``; its id must come from the
    data, so that a repeated task does no harm.
    """

    @classmethod
    def name(cls) -> str:
        return "client_points"

    def writer(self, schema, overwrite: bool) -> PointWriter:
        return PointWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(ClientPoints)

"""Document collections read in splits of even size, whatever the distribution of the key.

The store is asked for a sample of keys; its quantiles are the split points, and each split is one task that asks for
its own range. A value that more documents share than a split should hold is cut by the document's id. Filters that
Spark hands down go into each request, and so do the columns of the wanted schema.

A store is reached by a client, made on the driver and in every task by ``client``, an importable ``module:function`` that
takes the options. :class:`FileCollection` is the client of a collection in Parquet files.
"""

from __future__ import annotations

import importlib
import random
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema

from clickloom.operators.saved import store_of

FORMAT = "document_collection"
# A condition is a column, one of these operators, and a value.
Condition = tuple[str, str, Any]
_OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in", IsNotNull: "known"}
# A point of the order by key and id; documents without key come first.
Point = tuple[Any, Any]


class Client(Protocol):
    """What a store has to offer."""

    def schema(self) -> pa.Schema: ...

    def sample(self, columns: Sequence[str], count: int) -> list[tuple]:
        """Values of these columns in ``count`` documents chosen at random, or in all if there are no more."""

    def find(
        self, columns: Sequence[str], conditions: Sequence[Condition], key: str, own_id: str, low: Point | None, high: Point | None
    ) -> Iterator[pa.RecordBatch]:
        """Documents that meet the conditions from ``low`` up to but without ``high``, in the order (key, id)."""


class FileCollection:
    """A collection in Parquet files below the option ``path``."""

    def __init__(self, options: Mapping[str, str]) -> None:
        store, path = store_of(options["path"])
        self.data = ds.dataset(path, filesystem=store, format="parquet")

    def schema(self) -> pa.Schema:
        return self.data.schema

    def sample(self, columns: Sequence[str], count: int) -> list[tuple]:
        total = self.data.count_rows()
        chosen = sorted(random.Random(7).sample(range(total), min(count, total)))
        table = self.data.take(pa.array(chosen, pa.int64()), columns=list(dict.fromkeys(columns)))
        return list(zip(*(table.column(name).to_pylist() for name in columns), strict=True))

    def find(self, columns, conditions, key, own_id, low, high):
        parts = [_expression(*condition) for condition in conditions]
        field, number = ds.field(key), ds.field(own_id)
        if low is not None:
            after = field > low[0] if low[0] is not None else field.is_valid()
            same = field == low[0] if low[0] is not None else field.is_null()
            parts.append(after | (same & (number >= low[1])))
        if high is not None:
            before = (field < high[0]) | field.is_null() if high[0] is not None else ds.scalar(False)
            same = field == high[0] if high[0] is not None else field.is_null()
            parts.append(before | (same & (number < high[1])))
        chosen = reduce(lambda a, b: a & b, parts) if parts else None
        yield from (batch for batch in self.data.to_batches(columns=list(columns), filter=chosen) if batch.num_rows)


def _expression(column: str, operator: str, value: Any) -> ds.Expression:
    field = ds.field(column)
    if operator == "known":
        return field.is_valid()
    if operator == "in":
        return field.isin(list(value))
    return {"=": field == value, ">": field > value, ">=": field >= value, "<": field < value, "<=": field <= value}[operator]


def connect(options: Mapping[str, str]) -> Client:
    module, _, name = options.get("client", f"{__name__}:FileCollection").partition(":")
    return getattr(importlib.import_module(module), name)(options)


def split_points(sample: Iterable[Point], splits: int) -> list[Point]:
    """Points that cut a sample into at most so many parts of even size."""
    ordered = sorted(sample, key=lambda point: (point[0] is not None, point))
    at = [ordered[len(ordered) * n // splits] for n in range(1, splits)] if ordered else []
    return [point for n, point in enumerate(at) if n == 0 or point != at[n - 1]]


@dataclass
class Split(InputPartition):
    low: Point | None
    high: Point | None


class DocumentCollection(DataSource):
    """Options: ``client`` and what it needs, ``partitionKey`` (default ``_id``), ``idKey`` (default ``_id``), ``partitions``,
    ``samplesPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return from_arrow_schema(connect(self.options).schema())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = _FilteringReader if self.options.get("pushdown") == "true" else _Reader
        return kind(dict(self.options), schema.fieldNames())


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        lower = {name.lower(): value for name, value in options.items()}
        self.options, self.columns, self.conditions = options, columns, []
        self.id = lower.get("idkey", "_id")
        self.key = lower.get("partitionkey", self.id)
        self.splits = int(lower.get("partitions", "8"))
        self.samples = int(lower.get("samplesperpartition", "100"))

    def partitions(self) -> Sequence[InputPartition]:
        sample = connect(self.options).sample([self.key, self.id], self.splits * self.samples)
        points = split_points(sample, self.splits)
        return [Split(low, high) for low, high in zip([None, *points], [*points, None], strict=True)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        found = connect(self.options).find(self.columns, self.conditions, self.key, self.id, partition.low, partition.high)
        for batch in found:
            yield batch.select(self.columns)


class _FilteringReader(_Reader):
    """Hands simple filters to the store. Spark refuses such a reader where the session does not allow it."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            operator = _OPERATORS.get(type(one))
            if operator and len(one.attribute) == 1 and getattr(one, "value", 0) is not None:
                self.conditions.append((one.attribute[0], operator, getattr(one, "value", None)))
            else:
                yield one


def read_collection(
    spark: SparkSession, options: Mapping[str, str], columns: Sequence[str] | None = None, partition_key: str | None = None, partitions: int = 8
) -> DataFrame:
    """A collection in about ``partitions`` even splits by ``partition_key``, reduced to ``columns`` in the store.

    Filters on the result are handed to the store if ``spark.sql.python.filterPushdown.enabled`` is set, both now and when
    the frame runs. The splits are the same for all tasks of a frame; documents that come later may be in any of them.
    """
    spark.dataSource.register(DocumentCollection)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    own = {**options, "partitions": str(partitions), "pushdown": str(pushdown).lower()}
    if partition_key:
        own["partitionKey"] = partition_key
    reader = spark.read.format(FORMAT).options(**own)
    if columns is not None:
        whole = from_arrow_schema(connect(own).schema())
        reader = reader.schema(T.StructType([whole[name] for name in columns]))
    return reader.load()

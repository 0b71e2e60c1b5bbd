"""Collections read in even splits, with filters and columns handed to the store."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.sources import collection
from clickloom.sources.collection import read_collection, split_points


@pytest.fixture
def pushdown(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def stored(spark, tmp_path, rows, name="c"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, "_id long, k long, kind string, extra string").repartition(3).write.parquet(path)
    return path


def skewed(n=6000):
    """Half of all documents share a key, some have none, the others crowd at the low end."""
    source = random.Random(1)
    return [(i, None if i % 50 == 0 else 5 if i % 2 else int(source.paretovariate(0.5)), f"k{i % 4}", "x" * 20) for i in range(n)]


@pytest.mark.parametrize("key", ["k", "_id"])
def test_every_document_once_in_even_splits(spark, tmp_path, key):
    rows = skewed()
    df = read_collection(spark, {"path": stored(spark, tmp_path, rows)}, partition_key=key, partitions=8)
    assert sorted(map(str, (tuple(row) for row in df.collect()))) == sorted(map(str, rows))
    sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * len(rows) / 8


class Spy(collection.FileCollection):
    """Writes what it was asked for into a file."""

    def __init__(self, options):
        super().__init__(options)
        self.options = options

    def find(self, columns, conditions, *rest):
        with open(self.options["spy"], "a") as out:
            out.write(f"{sorted(columns)} {sorted(map(str, conditions))}\n")
        yield from super().find(columns, conditions, *rest)


def test_filters_and_columns_reach_the_store(spark, tmp_path, pushdown):
    rows, spy = skewed(900), tmp_path / "spy"
    options = {"path": stored(spark, tmp_path, rows), "client": "tests.test_collection:Spy", "spy": str(spy)}
    df = read_collection(spark, options, ["_id", "k", "kind"], "k", 4)
    got = df.filter((F.col("k") >= 5) & F.col("kind").isin("k1", "k3") & (F.length("kind") == 2)).collect()
    assert sorted(tuple(row) for row in got) == sorted(row[:3] for row in rows if row[1] is not None and row[1] >= 5 and row[2] in ("k1", "k3"))
    asked = set(spy.read_text().splitlines())
    assert len(asked) == 1
    assert "('k', '>=', 5)" in asked.copy().pop() and "'in'" in asked.copy().pop() and "extra" not in asked.pop()


def test_split_points():
    assert split_points([], 4) == [] and split_points([(1, 1)], 1) == []
    assert split_points([(5, n) for n in range(8)], 4) == [(5, 2), (5, 4), (5, 6)]
    assert split_points([(None, 2), (None, 1), (3, 0), (1, 9)], 2) == [(1, 9)]
    assert split_points([(1, 1)] * 10, 5) == [(1, 1)]


def test_empty_collection(spark, tmp_path):
    df = read_collection(spark, {"path": stored(spark, tmp_path, [])}, partition_key="k")
    assert df.collect() == [] and df.columns == ["_id", "k", "kind", "extra"]
    assert pa.schema(collection.connect({"path": str(tmp_path / "c")}).schema()).names == df.columns

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom.plans import loads, vectors
from clickloom.schemas import DATASET, POINT, PRODUCT
from clickloom.sources import files, vector_sink

SMALL = vectors.Word2VecSettings(min_count=1, num_partitions=2)


@pytest.fixture
def target(tmp_path):
    return loads.Collection(options={"path": str(tmp_path / "points")})


def stored(spark, target):
    return spark.read.parquet(target.options["path"])


def record(i, name="red ring"):
    return (f"2024-01-01 00:00:{i:02d}", "view", f"p{i}", "c", "b", "1.0", "u", "s", name)


@pytest.fixture
def dataset(spark):
    return spark.createDataFrame([record(1), record(1), record(2, None), record(3, "blue bolt")], DATASET)


def test_names_from_a_file_with_bad_lines(spark, tmp_path, target, dataset):
    path = str(tmp_path / "in")
    files.write_csv(dataset, path)
    (tmp_path / "in" / "more.csv").write_text(",".join(DATASET.fieldNames()) + "\ntoo,short\n")
    good, bad = loads.read_dataset(spark, path)
    assert [r._corrupt_record for r in bad.collect()] == ["too,short"]
    assert loads.load_names(good, target) == loads.load_names(good, target) == 3
    assert stored(spark, target).count() == 3
    assert stored(spark, target).schema == POINT


def test_names_to_a_store_without_ids_of_its_own(spark, tmp_path, dataset):
    vector_sink.register(spark)
    options = {"client": "file_store:connect", "url": str(tmp_path), "collection_name": "names"}
    store = loads.Collection("client_points", options, with_ids=True)
    assert loads.load_names(dataset, store) == loads.load_names(dataset, store) == 3
    sent = [point for name in (tmp_path / "names").glob("*.json") for point in json.loads(name.read_text())]
    # The second load replaced the points of the first.
    assert len(sent) == 3 and len({point[0] for point in sent}) == 3
    assert all(list(point[2]) == DATASET.fieldNames() for point in sent)


def test_combined(spark, target, dataset):
    assert loads.load_combined(dataset, target, SMALL) == 4
    assert stored(spark, target).columns == ["product_id", "vector"]


def test_training(spark, target, dataset):
    events = dataset.select("user_id", "product_id", "event_type", F.to_timestamp("event_time").alias("event_time"), "user_session")
    products = spark.createDataFrame([("p1", "red ring", "b", "c", "t", 1.0)], PRODUCT)
    assert loads.load_training(events, products, target, SMALL) == 2
    assert stored(spark, target).columns == vectors.TRAINING_COLUMNS


def test_retrain_adds_and_tells_the_trainer(spark, tmp_path, target, dataset):
    path = str(tmp_path / "extract")
    files.write_csv(dataset, path)
    for _ in range(2):
        message = json.loads(loads.load_retrain(spark, path, target).first().value)
    assert message["event"] == "data_ready" and message.keys() == {"event", "timestamp", "message"}
    assert stored(spark, target).count() == 8


def test_behaviors(spark, target, dataset):
    events = dataset.withColumn("event_time", F.to_timestamp("event_time"))
    scores = loads.load_behaviors(events, target, SMALL)
    assert stored(spark, target).count() == 4 and scores.columns == ["user_id", "product_id", "name", "score"]
    assert scores.count() == 3


def test_no_behaviors(spark, tmp_path, target, dataset):
    assert loads.load_behaviors(dataset.limit(0), target, SMALL) is None
    assert not (tmp_path / "points").exists()

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.plans.enrichment import enrich_events
from clickloom.sources import vector_sink
from clickloom.sources.topics import stream_lines
from clickloom.streaming import ingest, sinks, upsert
from tests.conftest import plan_of, rows_of


def event(i: int, **changes) -> str:
    base = {
        "user_session": f"s{i % 3}",
        "user_id": i,
        "product_id": f"p{i % 4}",
        "name": f"red ring {i % 2}",
        "event_type": "view",
        "event_time": f"2024-01-01T00:00:{i:02d}.000Z",
    }
    return json.dumps({**base, **changes})


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(f"p{i}", f"product {i}", "b", "c", "t", float(i)) for i in range(3)],
        schemas.PRODUCT,
    )


def run_ingest(spark, root, products, per_trigger=1):
    lines = stream_lines(spark, str(root / "in"), per_trigger)
    query = ingest.ingest_stream(lines, products, ingest.folder_sinks(str(root / "out")), str(root / "checkpoint"))
    query.awaitTermination()
    return len([p for p in query.recentProgress if p["numInputRows"]])


def raw(spark, root):
    return sinks.read_batches(spark, str(root / "out/behaviors"), schemas.BEHAVIOR)


def test_ingest_equals_batch_and_restarts_where_it_ended(spark, tmp_path, products):
    drop(tmp_path / "in", "1.json", *[event(i) for i in range(6)], "{bad")
    drop(tmp_path / "in", "2.json", *[event(i) for i in range(6, 10)])
    assert run_ingest(spark, tmp_path, products) == 2
    good, _ = ingest.split_records(ingest.tag_records(spark.read.text(str(tmp_path / "in"))))
    assert rows_of(raw(spark, tmp_path).drop("batch_id")) == rows_of(good)

    expected = enrich_events(good, products)
    enriched = sinks.read_batches(spark, str(tmp_path / "out/enriched"), expected.schema, "csv", {"header": "true"})
    assert rows_of(enriched.drop("batch_id")) == rows_of(expected) and expected.count() == 8

    dead = spark.read.parquet(str(tmp_path / "out/dead_letters"))
    assert [r.value for r in dead.collect()] == ["{bad"]

    assert run_ingest(spark, tmp_path, products) == 0
    assert raw(spark, tmp_path).count() == 10
    drop(tmp_path / "in", "3.json", event(10))
    assert run_ingest(spark, tmp_path, products) == 1
    assert raw(spark, tmp_path).count() == 11


def test_a_repeated_batch_counts_once(spark, tmp_path, products):
    drop(tmp_path / "in", "1.json", event(1), event(2))
    records = spark.read.text(str(tmp_path / "in"))
    target = ingest.folder_sinks(str(tmp_path / "out"))
    ingest.ingest_batch(records, products, target, 7)
    ingest.ingest_batch(records, products, target, 7)
    assert raw(spark, tmp_path).count() == 2


def test_raw_events_go_to_a_table_by_connector(spark, tmp_path, products):
    drop(tmp_path / "in", "1.json", event(1), event(2))
    path = {"path": str(tmp_path / "raw")}
    folders = ingest.folder_sinks(str(tmp_path / "out"))
    target = ingest.IngestSinks(sinks.table_connector("json", path), folders.enriched, folders.dead)
    ingest.ingest_batch(spark.read.text(str(tmp_path / "in")), products, target)
    assert sorted(r.user_id for r in spark.read.json(path["path"]).collect()) == [1, 2]


def run_upsert(spark, root, per_trigger=1):
    lines = stream_lines(spark, str(root / "in"), per_trigger)
    points, dead = sinks.batch_folder(f"{root}/points"), sinks.batch_folder(f"{root}/dead")
    upsert.upsert_stream(lines, points, dead, str(root / "checkpoint"), until_now=True).awaitTermination()
    return sinks.read_points(spark, f"{root}/points", upsert.POINT)


def test_points_are_upserted(spark, tmp_path):
    drop(tmp_path / "in", "1.json", event(1), event(1), event(2), "not json", event(3, name=None))
    found = run_upsert(spark, tmp_path)
    assert found.count() == 3
    assert {r.user_id: r.name for r in found.collect()} == {"1": "red ring 1", "2": "red ring 0", "3": None}
    assert all(len(r.vector) == 128 and sum(x * x for x in r.vector) == pytest.approx(1) for r in found.collect())
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == ["not json"]

    drop(tmp_path / "in", "2.json", event(1), event(2, name="renamed"), event(4))
    found = run_upsert(spark, tmp_path)
    assert {r.user_id: r.name for r in found.collect()} == {
        "1": "red ring 1", "2": "renamed", "3": None, "4": "red ring 0"
    }


def test_compacted_points_are_the_same(spark, tmp_path):
    for n in range(4):
        drop(tmp_path / "in", f"{n}.json", event(1, name=f"v{n}"), event(10 + n))
    found = rows_of(run_upsert(spark, tmp_path))
    path = f"{tmp_path}/points"
    assert sinks.compact_points(spark, path, upsert.POINT) == 2
    assert rows_of(sinks.read_points(spark, path, upsert.POINT)) == found
    assert [p.name for p in sorted((tmp_path / "points").glob("batch_id=*"))] == ["batch_id=3"]
    drop(tmp_path / "in", "4.json", event(1, name="last"))
    run_upsert(spark, tmp_path)
    assert sinks.compact_points(spark, path, upsert.POINT) == 3
    assert sinks.compact_points(spark, path, upsert.POINT) == 3
    names = {r.user_id: r.name for r in sinks.read_points(spark, path, upsert.POINT).collect()}
    assert names["1"] == "last" and len(names) == 5
    # Batches that an interrupted run left behind do no harm.
    spark.read.parquet(f"{path}/batch_id=4").write.parquet(f"{path}/batch_id=0")
    assert {r.user_id: r.name for r in sinks.read_points(spark, path, upsert.POINT).collect()} == names


def test_no_dead_letters_no_folder(spark, tmp_path):
    drop(tmp_path / "in", "1.json", event(1))
    run_upsert(spark, tmp_path)
    assert not (tmp_path / "dead").exists()
    assert sinks.read_batches(spark, f"{tmp_path}/dead", schemas.BEHAVIOR).count() == 0


def test_a_dirty_key_does_not_stop_the_stream(spark, tmp_path):
    numbers = spark.createDataFrame([(1, "one", "b", "c", "t", 1.0)], "product_id long, name string, brand string, category string, type string, price double")
    drop(tmp_path / "in", "1.json", event(1, product_id="1"), event(2, product_id="abc"), event(3, product_id=None))
    assert run_ingest(spark, tmp_path, numbers) == 1
    schema = enrich_events(spark.createDataFrame([], schemas.BEHAVIOR), numbers).schema
    enriched = sinks.read_batches(spark, str(tmp_path / "out/enriched"), schema, "csv", {"header": "true"})
    assert [(r.user_id, r.product_id, r.name) for r in enriched.collect()] == [(1, "1", "one")]
    assert raw(spark, tmp_path).count() == 3


def test_a_large_catalogue_is_not_sent_with_every_batch(spark):
    wide = [F.lit("x").alias(name) for name in ("name", "brand", "category", "type")]
    many = spark.range(ingest.BROADCAST_ROWS + 1).select(F.col("id").alias("product_id"), *wide, F.lit(1.0).alias("price"))
    assert not ingest.Catalogue(many).may_broadcast()
    assert ingest.Catalogue(many.limit(10)).may_broadcast()


def test_the_catalogue_is_measured_when_its_files_change(spark, tmp_path, products, monkeypatch):
    measured = []
    monkeypatch.setattr(ingest, "fits_broadcast", lambda df: measured.append(1) or True)
    for n in range(5):
        drop(tmp_path / "in", f"{n}.json", event(n))
    folder = str(tmp_path / "catalogue")
    products.write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert run_ingest(spark, tmp_path, stored) == 5
    assert len(measured) == 1
    catalogue = ingest.Catalogue(stored)
    assert [catalogue.may_broadcast() for _ in range(3)] == [True] * 3 and len(measured) == 2
    grown = next(path for path in (tmp_path / "catalogue").glob("*.parquet"))
    grown.write_bytes(grown.read_bytes() + b"more")
    assert catalogue.may_broadcast() and len(measured) == 3
    # Nothing tells how other catalogues grow, so they are measured with every batch.
    other = ingest.Catalogue(products)
    assert [other.may_broadcast() for _ in range(3)] == [True] * 3 and len(measured) == 6


def test_null_and_absent_name_embed_the_same(spark, tmp_path):
    absent = json.loads(event(1))
    absent.pop("name")
    absent["user_id"] = 2
    drop(tmp_path / "in", "1.json", event(1, name=None), json.dumps(absent))
    first, second = run_upsert(spark, tmp_path).collect()
    assert first.vector == second.vector and first.point_id != second.point_id


def test_the_last_position_wins_inside_a_batch(spark, tmp_path):
    rows = [(event(1, name=f"v{o}"), 0, o) for o in (3, 9, 5)]
    records = spark.createDataFrame(rows, "value string, partition int, offset long")
    upsert.upsert_batch(records, sinks.batch_folder(f"{tmp_path}/p"), sinks.batch_folder(f"{tmp_path}/d"))
    assert [r.name for r in sinks.read_points(spark, f"{tmp_path}/p", upsert.POINT).collect()] == ["v9"]


def test_points_go_to_a_store_by_id(spark, tmp_path):
    vector_sink.register(spark)
    options = {"client": "file_store:connect", "url": str(tmp_path), "collection_name": "online"}
    store = sinks.point_connector("client_points", options)
    records = spark.createDataFrame([(event(i % 5),) for i in range(20)], "value string")
    for _ in range(2):
        upsert.upsert_batch(records, store, sinks.batch_folder(f"{tmp_path}/d"))
    sent = [point for name in (tmp_path / "online").glob("*.json") for point in json.loads(name.read_text())]
    assert len(sent) == 10 and len({point[0] for point in sent}) == 5
    assert sent[0][2].keys() == {"user_session", "user_id", "product_id", "name", "event_type", "event_time"}


def test_copies_of_a_point_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("point_id"), F.col("id").alias("n"))
    plan = plan_of(sinks.latest_per(df, "point_id", ["n"]))
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below and "Partial" in below
    assert rows_of(sinks.latest_per(df, "point_id", ["n"])) == [(0, 99), (1, 97), (2, 98)]

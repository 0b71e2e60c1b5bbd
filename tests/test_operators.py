from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import aggregates, rows
from clickloom.plans import buyers, enrichment, retrain
from clickloom.plans.vectors import name_points, retrain_points
from clickloom.schemas import CATALOGUE_COLUMNS, DATASET, PRODUCT
from tests.conftest import plan_of, rows_of

EVENTS = "user_id int, product_id string, event_type string, event_time timestamp, user_session string, name string"


@pytest.fixture
def events(spark):
    time = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            (1, "A", "view", time, "s", "event name"),
            (1, "A", "purchase", time, "s", "event name"),
            (2, "B", "purchase", time, "t", None),
            (3, None, "purchase", time, "t", None),
            (4, "missing", "purchase", time, "t", None),
        ],
        EVENTS,
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("A", "ring", "b1", "c", "t", 1.0), ("B", "bolt", None, None, "t", 2.0), (None, "none", "b", "c", "t", 3.0)],
        PRODUCT,
    )


@pytest.mark.parametrize("broadcast", [None, True, False])
def test_enrichment(events, products, broadcast):
    result = enrichment.enrich_events(events, products, broadcast)
    assert result.columns == [
        "user_id", "product_id", "event_type", "event_time", "user_session", "name", "brand", "category_code", "price"
    ]
    assert sorted((r.user_id, r.product_id, r.name, r.category_code) for r in result.collect()) == [
        (1, "A", "ring", "c.t"),
        (1, "A", "ring", "c.t"),
        (2, "B", "bolt", "t"),
    ]


def test_broadcast_only_of_a_measured_size(spark, events, products, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" in plan_of(enrichment.enrich_events(events, products, True))
        assert "SortMergeJoin" in plan_of(enrichment.enrich_events(events, products))
        assert not enrichment.fits_broadcast(products, max_rows=2)
        assert not enrichment.fits_broadcast(products, max_bytes=100)
        monkeypatch.setattr(enrichment, "fits_broadcast", lambda df: False)
        assert "SortMergeJoin" in plan_of(enrichment.enrich_events(events, products, True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_events_of_a_hot_product_are_split(spark, tmp_path, skew_settings):
    spark.range(0, 60000, 1, 16).select(
        F.col("id").cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product_id"),
        F.lit("view").alias("event_type"),
        F.timestamp_seconds("id").alias("event_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("user_session"),
    ).write.parquet(str(tmp_path / "e"))
    spark.range(0, 501, 1, 4).select(
        F.when(F.col("id") == 500, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("product_id"),
        *[F.lit("x").alias(c) for c in ("name", "brand", "category", "type")],
        F.lit(1.0).alias("price"),
    ).write.parquet(str(tmp_path / "p"))
    result = enrichment.enrich_events(spark.read.parquet(str(tmp_path / "e")), spark.read.parquet(str(tmp_path / "p")))
    assert len(result.collect()) == 60000
    assert "skew=true" in plan_of(result)


@pytest.mark.parametrize("types", ["string", "int"])
def test_hot_products_are_broadcast_beyond_the_size_limit(spark, monkeypatch, types):
    """A catalogue too large to broadcast: only the rows of hot products are."""
    events = spark.range(0, 3000, 1, 4).select(
        F.col("id").cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).cast(types).alias("product_id"),
        F.lit("view").alias("event_type"),
        F.timestamp_seconds("id").alias("event_time"),
        F.lit("s").alias("user_session"),
    )
    products = spark.range(40).select(
        F.col("id").cast("string").alias("product_id"),
        F.concat(F.lit("n"), "id").alias("name"),
        *[F.lit("x").alias(c) for c in ("brand", "category", "type")],
        F.lit(1.0).alias("price"),
    )
    expected = rows_of(enrichment.enrich_events(events, products))
    measured = enrichment.fits_broadcast
    monkeypatch.setattr(enrichment, "fits_broadcast", lambda df: measured(df, max_rows=10))
    result = enrichment.enrich_events(events, products, True, hot_rows=500)
    assert rows_of(result) == expected
    # Keys of another type are compared in the catalogue's, so the hot ones are found there too.
    assert "Union" in plan_of(result)
    assert "Union" not in plan_of(enrichment.enrich_events(events, products, False, hot_rows=5000))


def test_catalogue_merge_casts_and_drops(spark):
    behaviors = spark.createDataFrame(
        [("s", "view", "2024-01-01", 1, "event name", "A"), ("s", "view", "2024-01-02", 2, "n", "X")],
        "sessionId string, behavior string, event_time string, user_id int, product_name string, product_id string",
    )
    products = spark.createDataFrame(
        [("A", "b", "c", "t", 1.5)], "productID string, brand string, category string, type string, price double"
    )
    legacy = spark.createDataFrame(
        [("old", "cart", 7, "c.t", "b", "bad price", 3, "z", "name", 9)],
        "event_time string, event_type string, product_id int, category_code string, brand string, price string, "
        "user_id int, user_session string, name string, category_id int",
    )
    result = enrichment.merge_catalogue(behaviors, products, legacy)
    assert result.schema == DATASET
    assert rows_of(result) == [
        ("2024-01-01", "view", "A", "c.t", "b", "1.5", "1", "s", "event name"),
        ("old", "cart", "7", "c.t", "b", "bad price", "3", "z", "name"),
    ]


def test_catalogue_cleaning(spark):
    wide = spark.createDataFrame([tuple("abcdefghij")], T.StructType([T.StructField(c, T.StringType()) for c in [*CATALOGUE_COLUMNS, "image[1]"]]))
    result = enrichment.clean_catalogue(wide)
    assert result.columns == ["productID", "name", "rating", "category", "brand", "type", "price", "MainImage", "new_description"]
    assert tuple(result.first()) == (*"abcdefgh", "aQ==")


def test_top_buyers_break_ties_by_user(spark, events):
    assert [tuple(r) for r in buyers.top_buyers(events, 2).collect()] == [(1, 1), (2, 1)]
    assert sorted(r.user_id for r in buyers.top_buyer_rows(events, 2).collect()) == [1, 2]
    plan = plan_of(buyers.top_buyers(events, 2))
    assert "TakeOrderedAndProject" in plan
    rows_plan = plan_of(buyers.top_buyer_rows(events, 2))
    assert "BroadcastHashJoin" in rows_plan and "LeftSemi" in rows_plan


def test_distinct_counts_count_null_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "x int, y string")
    assert tuple(aggregates.distinct_counts(df, ["x", "y"]).first()) == (4, 2, 3)
    assert tuple(aggregates.distinct_counts(df.limit(0), ["x", "y"]).first()) == (0, 0, 0)


def test_set_operations_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows_of(rows.distinct_rows(df)) == [(1, None), (2, "x")]
    assert rows_of(rows.rows_except(df, df.filter("a = 1"))) == [(2, "x")]


def test_except_drops_copies_before_a_shuffled_join(spark, tmp_path, skew_settings):
    spark.range(100).select((F.col("id") % 3).alias("a")).write.parquet(str(tmp_path / "l"))
    df = spark.read.parquet(str(tmp_path / "l"))
    plan = plan_of(rows.rows_except(df, df.filter("a = 1")))
    left = plan.split("SortMergeJoin")[1].split(":- ")[1].split("\n   +- ")[0]
    assert plan.count("SortMergeJoin") == 1 and "HashAggregate(keys=[a" in left


def test_fill_touches_measures_only(spark):
    df = spark.createDataFrame([(None, None, 1)], "user_id int, n long, m long")
    assert tuple(rows.fill_measures(df, ["n", "m"]).first()) == (None, 0, 1)


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, None)], "x int, `y.z` string")
    assert rows_of(aggregates.profile(df)) == [("x", 3, 1, "1", "3"), ("y.z", 3, 1, "a", "b")]


def test_first_rows_and_layout(spark):
    df = spark.range(100, numPartitions=4)
    assert [r.id for r in aggregates.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert rows.by_hash(df, ["id"], 3).rdd.getNumPartitions() == 3
    assert rows.evenly(df, 5).rdd.getNumPartitions() == 5
    for laid_out in (rows.by_hash(df, ["id"]), rows.evenly(df)):
        assert sorted(r.id for r in laid_out.collect()) == list(range(100))


def test_persisted_frees_at_the_end(spark):
    df = spark.range(10)
    with rows.persisted(df) as kept:
        assert kept.count() == 10 and kept.is_cached
    assert not df.is_cached


def test_name_points_drop_duplicates(spark):
    row = ("t", "view", "p", "c", "b", "1", "u", "s", "red ring")
    points = name_points(spark.createDataFrame([row, row, (*row[:8], None)], DATASET))
    assert points.columns == [*DATASET.fieldNames(), "vector"]
    found = {r.name: r.vector for r in points.collect()}
    assert len(found) == points.count() == 2
    assert found[None] == [0.0] * 128 and sum(x * x for x in found["red ring"]) == pytest.approx(1)


def test_retrain_points_label_the_time(spark):
    row = ("2024-01-02T03:04:05.678Z", "view", "p", "c", "b", "1", "u", "s", "red ring")
    points = retrain_points(spark.createDataFrame([row, row, ("x", *row[1:])], DATASET))
    assert sorted(r.event_time for r in points.collect()) == ["2024-01-02 03:04:05 UTC"] * 2 + ["UTC"]


def test_retrain_event(spark):
    event = retrain.retrain_event(spark, 7)
    row = event.first()
    assert (row.event, row.n_points) == ("data_ready", 7) and row.timestamp > 1_600_000_000
    value = retrain.as_topic_value(event)
    parsed = value.select(F.from_json("value", "event string, timestamp long, message string, n_points long").alias("e")).first()["e"]
    assert parsed.event == "data_ready" and parsed.message == retrain.DEFAULT_MESSAGE and parsed.n_points is None

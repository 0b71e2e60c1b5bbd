from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from clickloom.functions.embedders import HashingEmbedder
from clickloom.plans import vectors as plans

SMALL = plans.Word2VecSettings(min_count=0, vector_size=16)


@pytest.fixture(scope="module")
def names(spark):
    texts = ["red ring", "blue bolt", "the small  red widget", None, "", "red ring", "the"]
    return spark.createDataFrame([(i, f"p{i}", t) for i, t in enumerate(texts * 10)], "user_id int, product_id string, name string")


def test_every_row_has_one_finite_vector_and_equal_names_equal_ones(names):
    rows = plans.behavior_vectors(names, SMALL).collect()
    assert len(rows) == 70
    by_name = {}
    for row in rows:
        assert len(row.vector) == 16 and all(math.isfinite(x) for x in row.vector)
        assert by_name.setdefault(row.name, row.vector) == row.vector
    for empty in (None, "", "the"):
        assert by_name[empty] == [0.0] * 16
    assert any(by_name["red ring"])


def test_the_seed_makes_it_repeatable(names):
    first = plans.behavior_vectors(names, SMALL).collect()
    assert first == plans.behavior_vectors(names, SMALL).collect()


def test_unknown_words_count_in_the_mean(spark, names):
    tokens = plans.word_tokens(names.select("name"), "name")
    model = plans.fit_word2vec(tokens, SMALL)
    df = spark.createDataFrame([("red",), ("red unheard",)], "name string")
    found = {r.name: r.vector for r in plans.word2vec_vectors(df, "name", SMALL, model).collect()}
    assert found["red unheard"] == pytest.approx([x / 2 for x in found["red"]], rel=1e-5)


def test_vocabulary_counts_rows(spark, names):
    tokens = plans.word_tokens(names.select("name"), "name")
    assert {r.word: r.n for r in plans.vocabulary(tokens, min_count=20).collect()} == {"red": 30, "ring": 20}


def test_the_number_of_tasks_is_the_callers(monkeypatch, names):
    asked = []
    real = plans.Word2Vec
    monkeypatch.setattr(plans, "Word2Vec", lambda **options: asked.append(options["numPartitions"]) or real(**options))
    plans.fit_word2vec(plans.word_tokens(names.select("name"), "name"), SMALL)
    assert asked == [SMALL.num_partitions]


def test_plans_take_an_embedder(names):
    events = names.select("name", F.lit(1).alias("user_id"), F.lit("p").alias("product_id"))
    found = plans.behavior_vectors(events, embedder=HashingEmbedder())
    assert found.columns == ["user_id", "product_id", "name", "vector"]
    assert all(len(row.vector) == 128 for row in found.collect())


def test_too_large_a_vocabulary_fails_first(monkeypatch, names):
    monkeypatch.setattr(plans, "MAX_NUMBERS", 16 * 3)
    with pytest.raises(ValueError, match="raise min_count"):
        plans.fit_word2vec(plans.word_tokens(names.select("name"), "name"), SMALL)


def test_no_frequent_word_fails_first(names):
    with pytest.raises(ValueError, match="lower min_count"):
        plans.fit_word2vec(plans.word_tokens(names.select("name"), "name"), plans.Word2VecSettings(min_count=1000))


def test_training_extract(spark):
    events = spark.range(40).select(
        F.col("id").cast("int").alias("user_id"),
        F.concat(F.lit("p"), F.col("id") % 2).alias("product_id"),
        F.lit("view").alias("event_type"),
        F.timestamp_seconds(F.col("id")).alias("event_time"),
        F.lit("s").alias("user_session"),
    )
    products = spark.createDataFrame(
        [("p0", "red ring", "b", "c", "t", 1.0), ("p1", None, "b", None, None, 2.0)],
        "product_id string, name string, brand string, category string, type string, price double",
    )
    settings = plans.Word2VecSettings(min_count=10, num_partitions=2)
    result = plans.training_vectors(events, products, settings)
    assert result.columns == plans.TRAINING_COLUMNS
    rows = result.collect()
    assert len(rows) == 40
    assert {r.event_time for r in rows if r.user_id == 1} == {"1970-01-01 00:00:01 UTC"}
    assert all(len(r.vector) == 128 and any(r.vector) == (r.name is not None) for r in rows)


def test_combined_vectors(spark):
    df = spark.createDataFrame(
        [("t", "view", f"p{i}", "c", "b", "1.0", "u", "s", "red ring") for i in range(12)],
        "event_time string, event_type string, product_id string, category_code string, brand string, price string, "
        "user_id string, user_session string, name string",
    )
    result = plans.combined_vectors(df, plans.Word2VecSettings(min_count=10, num_partitions=3))
    assert result.columns == ["product_id", "vector"]
    assert sorted(r.product_id for r in result.collect()) == sorted(f"p{i}" for i in range(12))

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickloom import schemas, session
from clickloom.functions import scalars, text, vectors
from clickloom.functions.embedders import HashingEmbedder, ModelEmbedder
from clickloom.plans import vectors as plans
from tests.conftest import plan_of, rows_of


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


def test_category_code_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, "x", None), (3, None, None)], "id int, category string, type string")
    assert rows_of(df.select("id", scalars.category_code())) == [(1, "x.y"), (2, "x"), (3, "")]


def test_combined_attributes_keep_their_order(spark):
    values = dict(zip(scalars.COMBINED_ATTRIBUTES, "abcdefghi"))
    df = spark.createDataFrame([values]).select(*sorted(values))
    assert one(df, scalars.combined_attributes()) == "a b c d e f g h i"
    assert one(df.withColumn("brand", F.lit(None).cast("string")), scalars.combined_attributes()) == "a b c e f g h i"


def test_utc_label_and_time_parsing(spark):
    df = spark.createDataFrame([("2024-02-03T04:05:06.789Z",), ("x",), (None,)], "t string")
    labels = df.withColumn("p", scalars.parse_event_time("t")).select(scalars.utc_label("p"))
    assert rows_of(labels) == [("2024-02-03 04:05:06 UTC",), ("UTC",), ("UTC",)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """The first time does not exist on New York's clocks."""
    texts = ["2024-03-10T02:30:00.123Z", "2024-01-01T03:04:05.000Z", "2024-11-03T01:30:00.000Z", "2024-01-01T03:04:05.000+01", "x"]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = df.withColumn("p", scalars.parse_event_time("t"))
        found = parsed.select("t", scalars.utc_label("p").alias("label"), F.unix_millis("p").alias("millis")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row.label for row in found] == ["2024-03-10 02:30:00 UTC", "2024-01-01 03:04:05 UTC", "2024-11-03 01:30:00 UTC", "UTC", "UTC"]
    assert found[0].millis == 1710037800123


def test_share_is_guarded(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None)], "part long, total long")
    assert rows_of(df.select(scalars.share("part", "total"))) == [(0.0,), (0.0,), (0.25,)]


def test_base64_has_one_line(spark):
    df = spark.createDataFrame([("x" * 200,)], "d string")
    assert "\r\n" in one(df, F.base64("d"))
    assert one(df, scalars.plain_base64("d")) == "eHh4" * 66 + "eHg="


def test_point_id_tells_null_empty_and_shifted_parts_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("ab", None), (None, "ab"), ("", "ab")], "x string, y string")
    assert len({row[0] for row in df.select(scalars.point_id("x", "y")).collect()}) == 5


def test_event_text_of_missing_parts(spark):
    df = spark.createDataFrame([("n", "view"), (None, "view"), ("n", None), (None, None)], "name string, event_type string")
    assert sorted(r[0] for r in df.select(scalars.event_text()).collect()) == [" ", " view", "n ", "n view"]


def test_tokens_of_blanks_stop_words_and_null(spark):
    df = spark.createDataFrame([(1, "Red  Widget and THE ring "), (2, None), (3, "")], "id int, name string")
    tokens = text.remove_stop_words(text.tokenize(df, "name"))
    found = {r.id: (r.words, r.filtered_words) for r in tokens.collect()}
    assert found[1] == (["red", "", "widget", "and", "the", "ring"], ["red", "", "widget", "ring"])
    assert found[2] == found[3] == ([""], [""])
    assert df.columns == ["id", "name"] and tokens.columns == ["id", "name", "words", "filtered_words"]


@pytest.mark.parametrize("dimension", [128, 100])
def test_hashing_embedder_against_python(spark, dimension):
    names = ["red ring", "red red bolt", "the", None, "", "a  b"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    result = plans.embed_names(df, HashingEmbedder(dimension))
    assert result.columns == ["id", "name", "vector"] and result.schema["vector"].dataType.simpleString() == "array<float>"
    for row in result.collect():
        counts = [0] * dimension
        for token in (row.name or "").split():
            if token not in ("the", "a"):
                counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dimension] += 1
        length = math.sqrt(sum(c * c for c in counts)) or 1
        assert row.vector == pytest.approx([c / length for c in counts], abs=1e-7)


def test_hashing_embedder_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("red ring",)], "name string")
    plan = plan_of(plans.embed_names(df))
    assert "Python" not in plan and "Exchange" not in plan


def first_letter_model():
    def load():
        return lambda texts: [[float(ord(t[0])) if t else 0.0] + [float(len(t))] * 200 for t in texts]

    return load


def test_model_embedder_keeps_every_row_and_cuts_vectors(spark):
    df = spark.range(0, 1000, 1, 7).select("id", F.concat(F.lit("w"), F.col("id") % 10).alias("name"))
    result = plans.embed_names(df, ModelEmbedder(first_letter_model(), batch_size=16)).collect()
    assert sorted(r.id for r in result) == list(range(1000))
    assert all(r.vector == [float(ord("w"))] + [2.0] * 127 for r in result)


def test_model_embedder_fails_on_short_vectors(spark):
    df = spark.createDataFrame([("red",)], "name string")
    with pytest.raises(PySparkException, match="dimension"):
        plans.embed_names(df, ModelEmbedder(first_letter_model(), dimension=500)).collect()


def test_distinct_embedding_equals_plain_embedding(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(["a ring", "a ring", None, "", "bolt"])], "id int, name string")
    plain, distinct = plans.embed_names(df), plans.embed_names(df, distinct=True)
    assert rows_of(plain.select("id", "name", "vector")) == rows_of(distinct.select("id", "name", "vector"))


def test_a_hot_name_is_split_when_vectors_are_joined_back(spark, tmp_path, skew_settings):
    spark.range(0, 40000, 1, 16).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot name").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("name"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).write.parquet(str(tmp_path / "n"))
    result = plans.embed_names(spark.read.parquet(str(tmp_path / "n")), HashingEmbedder(4), distinct=True)
    assert result.select("id").distinct().count() == 40000
    result.collect()
    assert "skew=true" in plan_of(result)


def test_vector_contract(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf])],
        "id int, vector array<float>",
    )
    good, bad = vectors.split_by_contract(df, dimension=2)
    assert rows_of(good) == [(1, [1.0, 2.0])]
    assert {r.id: r.violation for r in bad.collect()} == {
        2: "dimension", 3: "missing", 4: "element", 5: "element", 6: "element"
    }
    assert vectors.enforce_contract(good, dimension=2).count() == 1
    with pytest.raises(PySparkException, match="bad vector"):
        vectors.enforce_contract(df, dimension=2).collect()


def test_truncate_and_unit_length(spark):
    df = spark.createDataFrame([([3.0, 4.0, 9.0],), ([0.0, 0.0, 0.0],)], "v array<double>")
    cut = df.select(vectors.truncate("v", 2).alias("v"))
    assert cut.schema["v"].dataType.simpleString() == "array<float>"
    assert sorted(r[0] for r in cut.select(vectors.unit_length("v")).collect()) == [
        [0.0, 0.0],
        pytest.approx([0.6, 0.8]),
    ]


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("x", "7", 1), ("y", "no", 2)], "name string, user_id string, extra int")
    result = schemas.conform(df, schemas.BEHAVIOR)
    assert result.schema == schemas.BEHAVIOR
    assert sorted((r.name, r.user_id, r.product_id) for r in result.collect()) == [("x", 7, None), ("y", None, None)]


def test_object_store_settings_name_no_secret_of_their_own():
    conf = session.object_store_conf("http://store", "key", "secret", ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert all(key.startswith("spark.hadoop.fs.s3a.") for key in conf)


def test_shared_dir_lies_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_shuffle_partitions_grow_with_the_data():
    assert session.shuffle_partitions(1 << 30) == 400
    assert session.shuffle_partitions(1 << 40) == 8192


def test_a_model_sees_each_distinct_text_once(spark, tmp_path):
    seen = str(tmp_path)

    def load():
        import os
        import uuid

        def embed(texts):
            for _ in texts:
                open(os.path.join(seen, uuid.uuid4().hex), "w").close()
            return [[1.0] * 128 for _ in texts]

        return embed

    df = spark.range(0, 300, 1, 4).select("id", (F.col("id") % 7).cast("string").alias("name"))
    assert plans.embed_names(df, ModelEmbedder(load)).count() == 300
    plans.embed_names(df, ModelEmbedder(load)).collect()
    assert len(list(tmp_path.iterdir())) == 7

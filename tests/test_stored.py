"""Stored layouts, resumable distinct loads, profiles that merge, messages that drift."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import profiles
from clickloom.plans.distinct_load import DistinctLoad, digest
from clickloom.sources import drift
from clickloom.sources.tables import store_layout
from clickloom.streaming.sinks import batch_folder, read_batches
from tests.conftest import plan_of


def test_stored_buckets_need_no_exchange(spark, tmp_path):
    events = spark.range(5000).select((F.col("id") % 97).alias("product_id"), F.col("id").alias("event"), (F.col("id") % 13).alias("user"))
    goods = spark.range(97).select(F.col("id").alias("product_id"), F.lit("x").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = store_layout(events, "layout_events", str(tmp_path / "e"), ["product_id"], 4)
        right = store_layout(goods, "layout_goods", str(tmp_path / "g"), ["product_id"], 4)
        joined = left.join(right, "product_id")
        assert "Exchange" not in plan_of(joined) and joined.count() == 5000
        grouped = left.groupBy("product_id", "user").agg(F.count("*").alias("n"))
        assert "Exchange" not in plan_of(grouped) and grouped.agg(F.sum("n")).first()[0] == 5000
        assert "Exchange" in plan_of(events.join(goods, "product_id"))
        assert len(list((tmp_path / "e").glob("*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS layout_events")
        spark.sql("DROP TABLE IF EXISTS layout_goods")


SCHEMA = "a string, b long, c double"


def chunks(spark, seed=5, n=6):
    source = random.Random(seed)
    rows = [[(source.choice(["x", "y", "", None]), source.choice([None, *range(30)]), source.choice([0.5, None, -0.0])) for _ in range(60)] for _ in range(n)]
    return rows, [spark.createDataFrame(own, SCHEMA) for own in rows]


@pytest.mark.parametrize("ranges", [1, 16])
@pytest.mark.parametrize("stop_after", [None, "sink", "index"])
def test_a_stopped_load_goes_on(spark, tmp_path, ranges, stop_after, monkeypatch):
    rows, frames = chunks(spark, n=4)
    write, loads = batch_folder(f"{tmp_path}/rows"), []

    def sink(df, chunk):
        write(df, chunk)
        loads.append(chunk)
        if stop_after == "sink" and loads == [0, 1, 2]:
            raise InterruptedError

    load = DistinctLoad(spark, f"{tmp_path}/load", ranges)
    if stop_after == "index":
        real = DistinctLoad._commit
        monkeypatch.setattr(DistinctLoad, "_commit", lambda self, chunk: real(self, chunk) if chunk < 2 or loads.count(2) > 1 else exec("raise InterruptedError"))
    if stop_after:
        with pytest.raises(InterruptedError):
            load.load(frames, sink)
        assert load.committed() == [0, 1]
        assert DistinctLoad(spark, f"{tmp_path}/load", ranges).load(frames, sink) == 2
        assert loads == [0, 1, 2, 2, 3]
    else:
        assert load.load(frames, sink) == 4
    got = [tuple(row) for row in read_batches(spark, f"{tmp_path}/rows", frames[0].schema).drop("batch_id").collect()]
    want = spark.createDataFrame([row for own in rows for row in own], SCHEMA).distinct().collect()
    assert len(got) == len(want) and set(got) == {tuple(row) for row in want}
    assert load.load(frames, sink) == 0


def test_only_ranges_that_may_have_a_row_are_read(spark, tmp_path):
    load = DistinctLoad(spark, str(tmp_path / "load"), 64)
    first = spark.range(300).select(F.col("id").cast("string").alias("a"))
    load.load_chunk(first, 0, lambda df, n: df.count())
    asked = []
    real = load._read
    load._read = lambda what, schema, chunks: asked.append(what) or real(what, schema, chunks)
    new = spark.range(1000, 1100).select(F.col("id").cast("string").alias("a"))
    own = new.withColumn("digest", digest(new)).withColumn("range", F.pmod(F.xxhash64("digest"), F.lit(64)).cast("int"))
    assert load.new_rows(own, [0]).count() == 100 and asked == ["bloom"]
    old = first.limit(1)
    own = old.withColumn("digest", digest(old)).withColumn("range", F.pmod(F.xxhash64("digest"), F.lit(64)).cast("int"))
    found = load.new_rows(own, [0])
    assert found.count() == 0 and "index" in asked and "range" in plan_of(found)


def test_merged_profiles_equal_the_whole(spark):
    source = random.Random(3)
    rows = [(f"d{n % 7}", source.choice([None, -40_000, -1, 0, 1, 32_768, 32_769, *range(100)]), source.choice([None, source.gauss(0, 1)])) for n in range(3000)]
    df = spark.createDataFrame(rows, "day string, n long, x double")
    days = profiles.states(df, F.col("day"), ["n", "x"])
    merged = profiles.merged_states(days, F.when(F.col("part") < "d3", "early").otherwise("late"))
    for parts in (days, merged, profiles.states(df, F.lit(0), ["n", "x"])):
        found = {row.column_name: row for row in profiles.profile_of(parts, [0.0, 0.5, 1.0]).collect()}
        whole, broken = [r[1] for r in rows if r[1] is not None], sorted(r[2] for r in rows if r[2] is not None)
        assert found["n"][1:6] == (3000, 3000 - len(whole), min(whole), max(whole), len(set(whole)))
        assert found["x"].n_distinct is None and found["x"].n_nulls == 3000 - len(broken)
        assert found["x"].quantiles[0] == broken[0] and found["x"].quantiles[2] == broken[-1]
        rank = sum(x <= found["x"].quantiles[1] for x in broken) / len(broken)
        assert 0.47 < rank < 0.53
    with pytest.raises(TypeError):
        profiles.states(df, F.col("day"), ["day"])


def test_states_of_sparse_numbers_are_small(spark):
    """Numbers far apart take a word each, and no table of 32,768 bits."""
    df = spark.range(2000).select((F.col("id") % 20).alias("day"), (F.col("id") * 70_000 - 10**7).alias("n"))
    days = profiles.states(df, F.col("day"), ["n"])
    words = days.filter("bucket IS NOT NULL")
    assert words.schema["bits"].dataType == T.LongType() and words.count() == 2000
    assert profiles.profile_of(profiles.merged_states(days, F.col("part") % 3)).first().n_distinct == 2000


USER = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("at", T.TimestampType())])


def test_what_messages_hold_beyond_the_schema(spark):
    messages = [
        '{"user_id": 1, "name": "a", "at": "2024-01-01T00:00:00Z"}', '{"user_id": "2", "name": null, "new": {"x": [1]}}', '{"user_id": "two", "at": "soon"}',
        "[1]", "{bad", "7", None, '{"name": 5, "new": 1.5}', "{}",
    ]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    rows = drift.with_unknown(df, USER).collect()
    assert len(rows) == 8 and sum(row.broken for row in rows) == 3
    good = {str(row.user_id) + str(row.name): row for row in rows if not row.broken}
    assert good["1a"].at is not None and good["1a"].unknown is None and good["1a"].misfits is None
    assert json.loads(good["2None"].unknown) == {"new": {"x": [1]}}
    lost = [json.loads(row.misfits) for row in rows if row.misfits]
    assert lost == [{"user_id": '"two"', "at": '"soon"'}]
    assert json.loads(good["None5"].unknown) == {"new": 1.5}
    seen = {(row.field, row.type): (row.known, row.fits, row.n) for row in drift.drift(df, USER).collect()}
    assert seen[("user_id", "BIGINT")] == (True, True, 1) and seen[("user_id", "STRING")] == (True, False, 2)
    assert seen[("name", "VOID")] == (True, True, 1) and seen[("name", "BIGINT")] == (True, False, 1)
    assert seen[("new", "OBJECT")] == (False, False, 1) and seen[("at", "STRING")] == (True, True, 2)
    assert "user_id" in drift.schema_seen(df).first().schema

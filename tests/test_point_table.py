"""The point table: versions, repeated batches, compaction of what changed, readers of older versions; stateful upserts."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from clickloom.sources.topics import stream_lines
from clickloom.streaming import sinks, upsert
from clickloom.streaming.point_table import PointTable
from tests.test_streaming import drop, event

SCHEMA = T.StructType([T.StructField("point_id", T.StringType()), T.StructField("n", T.LongType())])


def points(spark, ids, n):
    return spark.createDataFrame([(f"p{i}", n) for i in ids], SCHEMA)


def content(df):
    return {row.point_id: row.n for row in df.collect()}


def files(root):
    return {str(path.relative_to(root)) for path in root.rglob("*.parquet") if "data" in path.parts}


def test_newest_points_and_repeated_batches(spark, tmp_path):
    table = PointTable(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    assert content(table.read()) == {} and table.compact() == []
    table.write(points(spark, range(10), 0), 0)
    table.write(points(spark, range(5, 15), 1), 1)
    table.write(points(spark, range(0, 3), 9), 1)  # a repetition of a batch that is in
    want = {f"p{i}": int(i >= 5) for i in range(15)}
    assert content(table.read()) == want
    assert content(table.read(version=1)) == {f"p{i}": 0 for i in range(10)}
    table.write(points(spark, [], 2), 2)
    assert content(table.read()) == want and table.snapshot().batch == 2


def test_a_batch_without_manifest_counts_for_nothing(spark, tmp_path):
    """A writer that dies before the manifest leaves files that nobody lists, and writes them anew."""
    table = PointTable(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    table.write(points(spark, range(10), 0), 0)
    table._written(points(spark, range(10), 7).selectExpr("*", "2L AS _version"), "batch=1")
    assert set(content(table.read()).values()) == {0}
    table.write(points(spark, range(3), 1), 1)
    assert content(table.read()) == {f"p{i}": int(i < 3) for i in range(10)}


def test_compaction_rewrites_only_buckets_that_changed(spark, tmp_path):
    root = tmp_path / "t"
    table = PointTable(spark, str(root), SCHEMA, buckets=16)
    table.write(points(spark, range(200), 0), 0)
    table.write(points(spark, [3, 4], 1), 1)
    before, old = files(root), table.read()
    touched = table.compact()
    assert 1 <= len(touched) <= 2
    new = files(root) - before
    assert new and all(f"bucket={name.split('bucket=')[1].split('/')[0]}" in {f"bucket={b}" for b in touched} for name in new)
    assert before <= files(root)  # nothing that older versions list has gone
    assert content(old) == content(table.read()) == {f"p{i}": int(i in (3, 4)) for i in range(200)}
    assert table.compact() == []


def test_readers_of_a_kept_version_survive_compaction_and_vacuum(spark, tmp_path):
    root = tmp_path / "t"
    table = PointTable(spark, str(root), SCHEMA, buckets=2)
    for batch in range(3):
        table.write(points(spark, range(batch, 20), batch), batch)
    reader, want = table.read(), content(table.read())
    table.compact()
    gone = table.vacuum(keep=2)
    assert content(reader) == want == content(table.read())
    assert not gone  # the version before the compaction lists all of it
    assert table.vacuum(keep=1) and content(table.read()) == want
    assert not any("batch=" in name for name in files(root))


def run(spark, root, horizon):
    points, dead = sinks.batch_folder(f"{root}/points"), sinks.batch_folder(f"{root}/dead")
    query = upsert.upsert_stream(stream_lines(spark, str(root / "in"), 1), points, dead, str(root / "c"), until_now=True, horizon=horizon)
    query.awaitTermination()
    return query


def test_points_are_written_once_across_batches_and_restarts(spark, tmp_path):
    drop(tmp_path / "in", "1.json", *[event(i) for i in range(6)], "{bad")
    drop(tmp_path / "in", "2.json", *[event(i) for i in range(3, 9)], event(1, event_time="2020-01-01T00:00:00.000Z"))
    first = run(spark, tmp_path, "1 day")
    assert any(state["numRowsTotal"] for p in first.recentProgress for state in p["stateOperators"])
    assert "RocksDB" in json.dumps([p["stateOperators"] for p in first.recentProgress][-1]) or first.recentProgress[-1]["stateOperators"][0]["customMetrics"]
    written = sinks.read_batches(spark, f"{tmp_path}/points", upsert.POINT)
    assert written.count() == written.select("point_id").distinct().count() == 10
    # The state outlives the query; an event of long ago is new all the same.
    drop(tmp_path / "in", "3.json", event(0), event(8), event(9), event(2, event_time="2019-01-01T00:00:00.000Z"))
    run(spark, tmp_path, "1 day")
    written = sinks.read_batches(spark, f"{tmp_path}/points", upsert.POINT)
    assert written.count() == written.select("point_id").distinct().count() == 12
    assert [row.value for row in spark.read.parquet(f"{tmp_path}/dead").collect()] == ["{bad"]


def test_without_a_horizon_repetitions_are_written_again(spark, tmp_path):
    drop(tmp_path / "in", "1.json", event(1))
    drop(tmp_path / "in", "2.json", event(1))
    run(spark, tmp_path, None)
    assert sinks.read_batches(spark, f"{tmp_path}/points", upsert.POINT).count() == 2

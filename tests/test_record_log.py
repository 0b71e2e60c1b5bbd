"""Record logs: offsets, bounded batches, restarts, counts, whole commits."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom.sources import record_log
from clickloom.sources.record_log import Log, append, bounded, count_messages, create_topic, log_options, offsets
from clickloom.sources.topics import partition_counts, read_topic, stream_topic


def records(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("v"), "id").alias("value"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").cast("string").alias("key"))


def log(spark, tmp_path, *ranges, partitions=3):
    path = str(tmp_path / "log")
    create_topic(path, "t", partitions)
    for low, high in ranges:
        append(records(spark, low, high), path, "t")
    return path


def test_offsets_follow_each_other_in_every_partition(spark, tmp_path):
    path = log(spark, tmp_path, (0, 100), (100, 130))
    rows = read_topic(spark, log_options(path, ["t"]), record_log.FORMAT).collect()
    assert sorted(int(row.value[1:]) for row in rows) == list(range(130)) and all(row.key == row.value[1:] for row in rows)
    for p in range(3):
        own = sorted((row.offset, int(row.value[1:])) for row in rows if row.partition == p)
        assert [offset for offset, _ in own] == list(range(len(own)))
        # What was appended first comes first.
        assert max(n for _, n in own[: sum(n % 3 == p for n in range(100))]) < 100
    df = read_topic(spark, log_options(path, ["t"]), record_log.FORMAT)
    found = {row.partition: (row.earliest, row.latest, row.messages) for row in partition_counts(df).collect()}
    known = {row.partition: (row.earliest, row.latest, row.messages) for row in offsets(spark, path).collect()}
    assert found == known


def test_empty_and_unknown_topics_differ(spark, tmp_path):
    path = log(spark, tmp_path)
    assert [count_messages(offsets(spark, path), topic).first().messages for topic in ("t", "u")] == [0, -1]
    assert read_topic(spark, log_options(path, ["t"]), record_log.FORMAT).count() == 0
    assert offsets(spark, str(tmp_path / "nothing")).count() == 0
    with pytest.raises(Exception, match="no such topic"):
        read_topic(spark, log_options(path, ["u"]), record_log.FORMAT).count()
    with pytest.raises(Exception, match="no such topic"):
        append(records(spark, 0, 3), path, "u")


def test_limits_are_shared_out():
    assert bounded({}, {"a": 10, "b": 30}, 8) == {"a": 2, "b": 6}
    assert bounded({"a": 9}, {"a": 10, "b": 3, "c": 0}, 3) == {"a": 10, "b": 2, "c": 0}
    assert bounded({"a": 1}, {"a": 2}, 5) == {"a": 2}
    for limit in range(1, 40):
        end = bounded({"a": 3, "b": 0}, {"a": 20, "b": 19, "c": 1}, limit)
        assert sum(end.values()) - 3 == min(limit, 37)


def drain(spark, path, out, checkpoint, limit=None):
    """All batches until there is nothing new: the offsets of each."""
    sizes = []

    def keep(batch, number):
        rows = [(row.partition, row.offset) for row in batch.collect()]
        sizes.append(len(rows))
        (out / f"{number}.json").write_text(json.dumps(rows))

    query = stream_topic(spark, log_options(path, ["t"], limit), record_log.FORMAT).writeStream.foreachBatch(keep)
    query = query.option("checkpointLocation", str(checkpoint)).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sizes


def read_once(out):
    found = [tuple(row) for file in out.glob("*.json") for row in json.loads(file.read_text())]
    assert len(found) == len(set(found))
    return len(found)


def test_bounded_batches_and_restarts(spark, tmp_path):
    path = log(spark, tmp_path, (0, 50))
    out = tmp_path / "out"
    out.mkdir()
    sizes = drain(spark, path, out, tmp_path / "c", 20)
    assert max(sizes) <= 20 and sum(sizes) == 50
    # The second start goes on where the first one ended, with the same bound.
    append(records(spark, 50, 95), path, "t")
    sizes = drain(spark, path, out, tmp_path / "c", 20)
    assert max(sizes) <= 20 and sum(sizes) == 45 and read_once(out) == 95
    assert sum(drain(spark, path, out, tmp_path / "c", 20)) == 0


def test_a_failed_batch_is_read_again(spark, tmp_path):
    path = log(spark, tmp_path, (0, 30))
    options = log_options(path, ["t"], 10)

    def fail(batch, number):
        if number == 1:
            raise RuntimeError("lost")
        (tmp_path / f"{number}").write_text(str(batch.count()))

    query = stream_topic(spark, options, record_log.FORMAT).writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c")).start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    out = tmp_path / "out"
    out.mkdir()
    assert sum(drain(spark, path, out, tmp_path / "c", 10)) == 20 and read_once(out) == 20


def test_unbounded_stream_and_new_partitions(spark, tmp_path):
    path = log(spark, tmp_path, (0, 30), partitions=2)
    out = tmp_path / "out"
    out.mkdir()
    assert drain(spark, path, out, tmp_path / "c") == [30]
    create_topic(path, "t", 3)
    append(records(spark, 30, 60), path, "t")
    assert sum(drain(spark, path, out, tmp_path / "c")) == 30
    assert read_once(out) == 60


def test_files_of_a_failed_append_are_no_segments(spark, tmp_path):
    path = log(spark, tmp_path, (0, 10))
    broken = records(spark, 0, 1000).withColumn("value", F.expr("if(key = '900', raise_error('broken'), value)"))
    with pytest.raises(Exception, match="broken"):
        append(broken, path, "t")
    assert sum(s[-1].next for s in Log(path).segments(["t"]).values()) == 10

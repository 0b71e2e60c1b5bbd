"""Previous events by ranges of the order, whatever the size of a session."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators.sessions import previous_by_ranges, time_spent
from clickloom.plans.scoring import interaction_scores, interaction_shares

START = datetime(2024, 3, 1, 12)
SCHEMA = "event_id long, user_session string, event_time timestamp, x string"


def events(n=600, hot=0.0, seed=1):
    source = random.Random(seed)
    rows = []
    for event in range(n):
        session = "hot" if source.random() < hot else source.choice(["a", "b", "c", None, "", f"s{source.randrange(60)}"])
        time = None if source.random() < 0.03 else START + timedelta(milliseconds=100 * source.randrange(3 * n))
        rows.append((event, session, time, source.choice(["p", None])))
    return rows


def expected(rows):
    """event_id and the time before, by walking the sorted rows."""
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or START, r[0]))
    found, last = {}, None
    for row in order:
        found[row[0]] = last[2] if last is not None and last[1] == row[1] else None
        last = row
    return found


@pytest.mark.parametrize(("ranges", "batch", "hot"), [(1, 10_000, 0.0), (7, 10_000, 0.0), (7, 1, 0.3), (40, 3, 0.9), (200, 2, 0.5)])
def test_previous_times(spark, ranges, batch, hot):
    """Ranges and batches of any size, of one row, and empty ones; null is a session and a time."""
    rows = events(150 if batch < 10 else 600, hot)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        out = previous_by_ranges(df, "user_session", "event_time", ["event_id"], "before", ranges)
        assert out.columns == [*df.columns, "before"]
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(tuple(row)[:4] for row in got) == sorted(rows)
    assert {row.event_id: row.before for row in got} == expected(rows)


def test_even_tasks_for_a_session_of_most_rows(spark, tmp_path):
    rows = events(4000, 0.9)
    df = spark.createDataFrame(rows, SCHEMA)
    spent = time_spent(df, "event_id")
    table = spent.inputFiles()[0].rsplit("/", 1)[0]
    sizes = [row["count"] for row in spark.read.parquet(table).groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * 4000 / len(sizes)
    plain = time_spent(df, "event_id", hot_rows=None)
    assert sorted(spent.collect(), key=str) == sorted(plain.collect(), key=str)


def test_scores_by_ranges_equal_plain_ones(spark):
    source = random.Random(4)
    rows = [
        (n, "hot" if n % 10 else source.choice(["a", None]), source.choice([1, 2, None, *range(50)]), source.choice([7, 8, None]), source.choice(["x", "y"]),
         source.choice(["view", "cart", "purchase", "other"]), START + timedelta(seconds=source.randrange(900)))
        for n in range(1500)
    ]
    df = spark.createDataFrame(rows, "event_id long, user_session string, product_id long, user_id long, name string, event_type string, event_time timestamp")
    for plan in (interaction_scores, interaction_shares):
        ranged, plain = (plan(df, tie_breakers=["event_id"], hot_rows=way) for way in (-1, None))
        assert sorted(map(str, ranged.collect())) == sorted(map(str, plain.collect()))


def test_no_events(spark):
    assert time_spent(spark.createDataFrame([], SCHEMA), "event_id").collect() == []
    one = spark.createDataFrame([(1, "a", START, None)], SCHEMA).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    assert [(row.prev_event_time, row.time_spent) for row in time_spent(one, "event_id").collect()] == [(None, 0.0)]

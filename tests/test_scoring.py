from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators.aggregates import session_product_counts, session_totals
from clickloom.operators.sessions import time_spent
from clickloom.operators.skew import hot_keys, is_hot
from clickloom.plans import scoring
from tests.conftest import plan_of, rows_of

SCHEMA = (
    "event_id long, user_session string, user_id int, product_id string, name string, event_type string, "
    "event_time timestamp"
)
START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def scores(events, **options):
    result = scoring.interaction_scores(events, with_session=True, tie_breakers=["event_id"], **options)
    return {(r.user_session, r.user_id, r.product_id, r.name): r.score for r in result.collect()}


# hot_rows=1 sends every session the way of the hot ones.
both_ways = pytest.mark.parametrize("hot_rows", [1, 10**9])


@both_ways
def test_one_session(spark, hot_rows):
    events = spark.createDataFrame(
        [
            (1, "s1", 1, "A", "a", "view", at(0)),
            (2, "s1", 1, "A", "a", "cart", at(10)),
            (3, "s1", 1, "B", "b", "view", at(30)),
            (4, "s1", 1, "B", "b", "purchase", at(60)),
        ],
        SCHEMA,
    )
    found = scores(events, hot_rows=hot_rows)
    assert found[("s1", 1, "A", "a")] == pytest.approx(0.05 + 0.25 + 0.2 / 6)
    assert found[("s1", 1, "B", "b")] == pytest.approx(0.05 + 0.45 + 1 / 6)


@both_ways
def test_single_event_has_no_time_share(spark, hot_rows):
    events = spark.createDataFrame([(1, "s", 1, "A", "a", "view", at(0))], SCHEMA)
    assert scores(events, hot_rows=hot_rows) == {("s", 1, "A", "a"): pytest.approx(0.1)}


@both_ways
def test_null_session_keeps_its_row_and_scores_nothing(spark, hot_rows):
    events = spark.createDataFrame([(1, None, 1, "A", "a", "view", at(0)), (2, None, 1, "A", "a", "cart", at(9))], SCHEMA)
    assert scores(events, hot_rows=hot_rows) == {(None, 1, "A", "a"): 0.0}


@both_ways
def test_null_product_has_no_time_share_but_counts_for_the_session(spark, hot_rows):
    events = spark.createDataFrame(
        [
            (1, "s", 1, "A", "a", "view", at(0)),
            (2, "s", 1, None, "x", "view", at(10)),
            (3, "s", 1, "A", "a", "other", at(20)),
        ],
        SCHEMA,
    )
    found = scores(events, hot_rows=hot_rows)
    assert found[("s", 1, None, "x")] == pytest.approx(0.05)
    assert found[("s", 1, "A", "a")] == pytest.approx(0.05 + 0.2 * 10 / 20)


@both_ways
def test_two_names_of_one_product_both_have_its_time(spark, hot_rows):
    events = spark.createDataFrame(
        [(1, "s", 1, "A", "old", "other", at(0)), (2, "s", 1, "A", "new", "other", at(10))], SCHEMA
    )
    assert scores(events, hot_rows=hot_rows) == {
        ("s", 1, "A", "old"): pytest.approx(0.2),
        ("s", 1, "A", "new"): pytest.approx(0.2),
    }


def test_event_time_as_text_and_malformed(spark):
    rows = [
        (1, "s", 1, "A", "a", "view", "2024-01-01T00:00:00.000Z"),
        (2, "s", 1, "B", "b", "view", "2024-01-01T00:00:10.500Z"),
        (3, "s", 1, "C", "c", "view", "x"),
    ]
    events = spark.createDataFrame(rows, SCHEMA.replace("event_time timestamp", "event_time string"))
    found = scores(events)
    assert found[("s", 1, "B", "b")] == pytest.approx(0.1 / 3 + 0.2)
    assert found[("s", 1, "C", "c")] == pytest.approx(0.1 / 3)


def random_events(seed: int, n: int) -> list[tuple]:
    """Events with nulls in all keys, ties in time, long gaps and one session with a third of all."""
    pick = random.Random(seed)
    rows = []
    for event_id in range(n):
        session = "hot" if pick.random() < 0.35 else pick.choice([None, "", "s1", "s2", "s3", "s4"])
        time = pick.choice([None, at(pick.randrange(5)), at(pick.random() * 20000), at(pick.random() * 10**6)])
        rows.append(
            (
                event_id,
                session,
                pick.choice([None, 1, 2, 3]),
                pick.choice([None, "A", "B", "C"]),
                pick.choice([None, "n1", "n2"]),
                pick.choice(["view", "cart", "purchase", "other", None]),
                time,
            )
        )
    return rows


def seconds(time: datetime) -> int:
    return int((time.replace(microsecond=0) - START).total_seconds())


def by_session(rows):
    sessions = defaultdict(list)
    for row in rows:
        sessions[row[1]].append(row)
    for events in sessions.values():
        events.sort(key=lambda r: (r[6] is not None, r[6] or START, r[0]))
    return sessions


def expected_times(rows) -> dict[int, tuple]:
    """event_id -> (previous time, seconds spent)."""
    found = {}
    for events in by_session(rows).values():
        previous = None
        for row in events:
            spent = seconds(row[6]) - seconds(previous) if previous and row[6] else 0
            found[row[0]] = (previous, float(spent))
            previous = row[6]
    return found


def expected_scores(rows) -> dict[tuple, float]:
    spent = expected_times(rows)
    found = {}
    for session, events in by_session(rows).items():
        total = {kind: sum(r[5] == kind for r in events) for kind in ("view", "cart", "purchase")}
        total_time = sum(spent[r[0]][1] for r in events)
        for key in {(r[2], r[3], r[4]) for r in events}:
            mine = [r for r in events if (r[2], r[3], r[4]) == key]
            score = 0.0
            if session is not None:
                for kind, weight in (("view", 0.1), ("cart", 0.25), ("purchase", 0.45)):
                    if total[kind]:
                        score += weight * sum(r[5] == kind for r in mine) / total[kind]
                if key[0] is not None and key[1] is not None and total_time > 0:
                    time = sum(spent[r[0]][1] for r in events if (r[2], r[3]) == key[:2])
                    score += 0.2 * time / total_time
            found[(session, *key)] = score
    return found


@both_ways
@pytest.mark.parametrize("seed", [1, 2])
def test_scores_against_brute_force(spark, seed, hot_rows):
    rows = random_events(seed, 400)
    found = scores(spark.createDataFrame(rows, SCHEMA), hot_rows=hot_rows)
    expected = expected_scores(rows)
    assert found.keys() == expected.keys()
    for key, score in expected.items():
        assert found[key] == pytest.approx(score, abs=1e-12), key


@pytest.mark.parametrize("hot_rows", [1, 100, 10**9])
def test_time_spent_against_brute_force(spark, hot_rows):
    rows = random_events(3, 400)
    result = time_spent(spark.createDataFrame(rows, SCHEMA), "event_id", hot_rows=hot_rows)
    found = {r.event_id: (r.prev_event_time, r.time_spent) for r in result.collect()}
    assert found == expected_times(rows)


def test_time_spent_without_time_zone(spark):
    events = spark.createDataFrame(random_events(3, 100), SCHEMA)
    local = events.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    for hot_rows in (1, 10**9):
        assert rows_of(time_spent(local, "event_id", hot_rows=hot_rows)) == rows_of(time_spent(events, "event_id"))


def test_only_large_sessions_are_hot(spark):
    events = spark.createDataFrame(random_events(4, 400), SCHEMA)
    hot = hot_keys(events, "user_session", 100)
    assert hot == [events.select(F.xxhash64(F.lit("hot")).alias("h")).first()["h"]]
    assert hot_keys(events, "user_session", 1000) == []


def test_the_search_for_hot_sessions_shuffles_no_row_per_session(spark):
    """One sketch for each task is all that is shuffled while the plan is built."""
    events = spark.range(100_000, numPartitions=4).select(F.col("id").cast("string").alias("user_session"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hot", "hot keys")
    try:
        assert hot_keys(events, "user_session", 10**6) == []
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("hot") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(info.numTasks for info in stages if info) <= 4 and len([info for info in stages if info]) <= 2 + 1
    assert hot_keys(events, "user_session", None) == []


def test_mixed_ways_agree(spark):
    rows = random_events(5, 400)
    events = spark.createDataFrame(rows, SCHEMA)
    mixed, cold = scores(events, hot_rows=100), scores(events)
    assert mixed.keys() == cold.keys()
    assert all(mixed[key] == pytest.approx(cold[key], abs=1e-12) for key in cold)


def test_counts_of_products_add_up_to_the_session(spark):
    events = spark.createDataFrame(random_events(6, 300), SCHEMA)
    per_product = session_product_counts(events).groupBy("user_session").agg(
        *[F.sum(f"product_{kind}").alias(f"total_{kind}") for kind in ("views", "carts", "purchases")]
    )
    assert rows_of(per_product) == rows_of(session_totals(events))


def test_scores_lie_between_0_and_1(spark):
    events = spark.createDataFrame(random_events(7, 300), SCHEMA)
    assert all(-1e-9 <= score <= 1 + 1e-9 for score in scores(events).values())


def test_product_and_session_time(spark):
    rows = random_events(8, 200)
    features = scoring.interaction_features(spark.createDataFrame(rows, SCHEMA), tie_breakers=["event_id"], hot_rows=50)
    spent, per_session = expected_times(rows), defaultdict(float)
    for row in rows:
        per_session[row[1]] += spent[row[0]][1]
    assert {r[0]: r[1] for r in scoring.session_time(features).collect()} == dict(per_session)
    assert sum(r[3] for r in scoring.product_time(features).collect()) == sum(per_session.values())


def test_ordinary_sessions_are_shuffled_once(spark, tmp_path):
    spark.createDataFrame(random_events(9, 200), SCHEMA).write.parquet(str(tmp_path / "e"))
    events = spark.read.parquet(str(tmp_path / "e"))
    plan = plan_of(scoring.interaction_scores(events, tie_breakers=["event_id"], hot_rows=None))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 2
    assert "Join" not in plan and "Python" not in plan


def test_no_step_groups_a_hot_session_alone(spark, tmp_path):
    spark.createDataFrame(random_events(10, 200), SCHEMA).write.parquet(str(tmp_path / "e"))
    plan = plan_of(scoring._features_of_hot_sessions(spark.read.parquet(str(tmp_path / "e")), scoring.EVENT_TYPES, []))
    assert "Exchange hashpartitioning(user_session" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning(" in line:
            keys = line.split("hashpartitioning(")[1].split("), ")[0].split(", ")[:-1]
            # Only the slice ends of a session meet by session alone.
            assert len(keys) > 1 or "_session" in keys[0]


def test_hot_sums_are_broadcast_and_no_hot_session_is_joined_by_shuffle(spark):
    events = spark.createDataFrame(random_events(11, 200), SCHEMA)
    shares = scoring._shares_of_hot_sessions(scoring._features_of_hot_sessions(events, scoring.EVENT_TYPES, []))
    plan = plan_of(shares)
    assert "BroadcastHashJoin [coalesce(user_session" in plan
    assert "SortMergeJoin [user_session" not in plan and "SortMergeJoin [coalesce(user_session" not in plan
    # The sums are made from the same shuffled interactions.
    shares.collect()
    final = plan_of(shares).split("== Initial Plan")[0]
    assert "ReusedExchange [user_session" in final


def test_copies_at_one_time_are_split(spark, tmp_path, skew_settings):
    """A third of all rows at one time of one session: the adaptive join splits them."""
    spark.range(0, 60000, 1, 16).select(
        F.col("id").alias("event_id"),
        F.lit("hot").alias("user_session"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("event_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).write.parquet(str(tmp_path / "e"))
    result = time_spent(spark.read.parquet(str(tmp_path / "e")), "event_id", hot_rows=1)
    assert len(result.collect()) == 60000
    assert "skew=true" in plan_of(result)


def test_extreme_hashes(spark):
    hashes = [-(2**63), 2**63 - 1, spark.range(1).select(F.xxhash64(F.lit(5).cast("bigint"))).first()[0]]
    found = spark.range(10).filter(is_hot("id", hashes)).collect()
    assert [r.id for r in found] == [5]
    assert spark.range(10).filter(is_hot("id", [])).count() == 0

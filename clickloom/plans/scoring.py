"""Interaction score of each (session, product, user) from count shares and time share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.scalars import indicator, parse_event_time, share
from clickloom.operators.aggregates import EVENT_TYPES, PRODUCT_COUNTS, SESSION_COUNTS
from clickloom.operators.sessions import RANGES, credited_seconds, previous_by_ranges, seconds_in_session
from clickloom.operators.skew import split_hot


# The weights of the four shares; they add up to 1.
@dataclass(frozen=True)
class Weights:
    views: float = 0.1
    carts: float = 0.25
    purchases: float = 0.45
    time: float = 0.2


INTERACTION = ["user_session", "product_id", "user_id"]
NAMED_INTERACTION = [*INTERACTION, "name"]


def _prepared(events: DataFrame, tie_breakers: Sequence[str]) -> DataFrame:
    """Only the columns needed, with the event time as a timestamp."""
    columns = dict.fromkeys([*NAMED_INTERACTION, "event_type", "event_time", *tie_breakers])
    kind = events.schema["event_time"].dataType.typeName()
    time = parse_event_time("event_time") if kind == "string" else F.col("event_time").cast("timestamp")
    return events.select(*columns).withColumn("event_time", time)


def _flags(event_types: Mapping[str, str]) -> list[Column]:
    return [
        indicator("event_type", event_types[kind]).cast("bigint").alias(name)
        for kind, name in PRODUCT_COUNTS.items()
    ]


def _summed(parts: DataFrame) -> DataFrame:
    measures = [*PRODUCT_COUNTS.values(), "time_spent"]
    return parts.groupBy(*NAMED_INTERACTION).agg(*[F.sum(name).alias(name) for name in measures])


def _features_of_sessions(events: DataFrame, event_types: Mapping[str, str], ties: Sequence[str]) -> DataFrame:
    """Counts and seconds where a session fits one task: one shuffle by session does it all."""
    seconds = seconds_in_session("user_session", "event_time", [*ties, "product_id", "user_id"])
    return _summed(events.select(*NAMED_INTERACTION, *_flags(event_types), seconds.alias("time_spent")))


def _features_by_ranges(events: DataFrame, event_types: Mapping[str, str], ties: Sequence[str]) -> DataFrame:
    """The same for sessions of any size: events look back inside ranges of the order, and counts and seconds
    are added up on the map side before they are shuffled by all four keys."""
    looked = previous_by_ranges(events, "user_session", "event_time", [*ties, "product_id", "user_id"], "_previous")
    spent = F.unix_timestamp("event_time") - F.unix_timestamp("_previous")
    return _summed(looked.select(*NAMED_INTERACTION, *_flags(event_types), F.coalesce(spent, F.lit(0)).alias("time_spent")))


def _features_of_hot_sessions(
    events: DataFrame, event_types: Mapping[str, str], ties: Sequence[str]
) -> DataFrame:
    """The same where a session does not fit one task.

    Events and seconds go through one aggregation that combines on the map side, so the rows of a
    session shrink to its distinct interactions before they are shuffled, by all four keys.
    """
    counted = events.select(*NAMED_INTERACTION, *_flags(event_types), F.lit(0).cast("bigint").alias("time_spent"))
    order = [*ties, "product_id", "user_id"]
    seconds = credited_seconds(events, "user_session", "event_time", NAMED_INTERACTION, order)
    zeros = [F.lit(0).cast("bigint").alias(name) for name in PRODUCT_COUNTS.values()]
    return _summed(counted.unionByName(seconds.select(*NAMED_INTERACTION, *zeros, "time_spent")))


def _shares(features: DataFrame) -> DataFrame:
    """F1 to F4 from counts, seconds and the sums of the session.

    An interaction without session has no shares, one without product or user no time share.
    """
    session = F.col("user_session").isNotNull()
    complete = session & F.col("product_id").isNotNull() & F.col("user_id").isNotNull()

    def guarded(known: Column, part: str, total: str) -> Column:
        return F.when(known, share(part, total)).otherwise(F.lit(0.0))

    return features.select(
        *NAMED_INTERACTION,
        guarded(session, "product_views", "total_views").alias("F1"),
        guarded(session, "product_carts", "total_carts").alias("F2"),
        guarded(session, "product_purchases", "total_purchases").alias("F3"),
        guarded(complete, "product_time_spent", "total_time_spent").alias("F4"),
    )


_TOTALS = {**{PRODUCT_COUNTS[kind]: name for kind, name in SESSION_COUNTS.items()}, "time_spent": "total_time_spent"}


def _shares_of_sessions(features: DataFrame) -> DataFrame:
    """Shares where a session fits one task: windows on the shuffle that is there already."""
    interaction = Window.partitionBy(*INTERACTION)
    # The sums need no order, but in this one both windows share a single sort.
    session = Window.partitionBy(INTERACTION[0]).orderBy(*INTERACTION[1:])
    session = session.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = features.withColumn("product_time_spent", F.sum("time_spent").over(interaction))
    return _shares(summed.withColumns({name: F.sum(part).over(session) for part, name in _TOTALS.items()}))


def _scattered() -> Column:
    """Interactions with a null key have no time share, so they need no sum and must not meet in one task."""
    complete = F.col(INTERACTION[0]).isNotNull()
    for key in INTERACTION[1:]:
        complete = complete & F.col(key).isNotNull()
    return F.when(~complete, F.xxhash64("name", *INTERACTION))


def _shares_of_hot_sessions(features: DataFrame) -> DataFrame:
    """The same where a session does not fit one task: its sums are joined.

    At most ``MOST_HOT_KEYS`` sessions are hot, so their sums are broadcast and the interactions
    stay where they are. Names of one interaction are few; interactions with a null key have no time
    share, so they need no sum and are scattered.
    """
    interaction = Window.partitionBy(*INTERACTION, _scattered())
    summed = features.withColumn("product_time_spent", F.sum("time_spent").over(interaction))
    totals = features.groupBy("user_session").agg(*[F.sum(part).alias(name) for part, name in _TOTALS.items()])
    # Null-safe, since a plain equality would put a filter on nulls below the sums, which would then
    # no longer share the shuffle of the interactions.
    same = F.col("i.user_session").eqNullSafe(F.col("t.user_session"))
    joined = summed.alias("i").join(F.broadcast(totals).alias("t"), same, "left")
    return _shares(joined.select("i.*", *_TOTALS.values()))


def _shares_by_join(features: DataFrame) -> DataFrame:
    """Shares for sessions of any size: their sums are joined, and where a session has very many interactions
    the adaptive skew join splits them."""
    interaction = Window.partitionBy(*INTERACTION, _scattered())
    summed = features.withColumn("product_time_spent", F.sum("time_spent").over(interaction))
    totals = features.groupBy("user_session").agg(*[F.sum(part).alias(name) for part, name in _TOTALS.items()])
    return _shares(summed.join(totals, "user_session", "left"))


def interaction_features(
    events: DataFrame,
    event_types: Mapping[str, str] = EVENT_TYPES,
    tie_breakers: Sequence[str] = (),
    hot_rows: int | None = RANGES,
) -> DataFrame:
    """Counts and seconds spent per session, product, user and product name.

    ``tie_breakers`` order events of one session at the same time. Sessions may be of any size, being cut into
    ranges. With ``hot_rows=None`` each session is handled in one task, for sessions known to be small; with a
    number, those of so many events are looked for and spread over many tasks.
    """
    if hot_rows == RANGES:
        return _features_by_ranges(_prepared(events, tie_breakers), event_types, tie_breakers)
    cold, hot = split_hot(_prepared(events, tie_breakers), "user_session", hot_rows)
    features = _features_of_sessions(cold, event_types, tie_breakers)
    return features if hot is None else features.unionByName(_features_of_hot_sessions(hot, event_types, tie_breakers))


def product_time(features: DataFrame) -> DataFrame:
    """Seconds per session, product and user."""
    return features.groupBy(*INTERACTION).agg(F.sum("time_spent").cast("double").alias("product_time_spent"))


def session_time(features: DataFrame) -> DataFrame:
    """Seconds per session."""
    return features.groupBy("user_session").agg(F.sum("time_spent").cast("double").alias("total_time_spent"))


def interaction_shares(
    events: DataFrame,
    event_types: Mapping[str, str] = EVENT_TYPES,
    tie_breakers: Sequence[str] = (),
    hot_rows: int | None = RANGES,
) -> DataFrame:
    """The shares F1 to F4 (views, carts, purchases, time) of each interaction in its session.

    A product with two names in one interaction has the time of both under each name.
    """
    if hot_rows == RANGES:
        return _shares_by_join(interaction_features(events, event_types, tie_breakers))
    cold, hot = split_hot(_prepared(events, tie_breakers), "user_session", hot_rows)
    shares = _shares_of_sessions(_features_of_sessions(cold, event_types, tie_breakers))
    if hot is None:
        return shares
    return shares.unionByName(_shares_of_hot_sessions(_features_of_hot_sessions(hot, event_types, tie_breakers)))


def interaction_scores(
    events: DataFrame,
    weights: Weights = Weights(),
    event_types: Mapping[str, str] = EVENT_TYPES,
    tie_breakers: Sequence[str] = (),
    with_session: bool = False,
    hot_rows: int | None = RANGES,
) -> DataFrame:
    """``user_id, product_id, name, score`` of every interaction.

    ``event_time`` is a timestamp, or text in the message format. ``with_session`` adds
    ``user_session`` in front.
    """
    shares = interaction_shares(events, event_types, tie_breakers, hot_rows)
    score = (
        F.lit(weights.views) * F.col("F1")
        + F.lit(weights.carts) * F.col("F2")
        + F.lit(weights.purchases) * F.col("F3")
        + F.lit(weights.time) * F.col("F4")
    )
    session = ["user_session"] if with_session else []
    return shares.select(*session, "user_id", "product_id", "name", score.cast("double").alias("score"))

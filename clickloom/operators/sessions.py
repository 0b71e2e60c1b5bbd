"""Time between the events of a session.

Events are laid out in ranges of (session, time, tie), each of them looks at the row before it, and the
last row of each range is carried to the next one through a small table. A session may hold any share of
all events: it simply lies in as many ranges as it needs, and nothing has to be known about it before.

Where sessions are known to be small, a window over each does the same without a table in between; hot
sessions can also be looked up level by level, first inside one time slice, then among the slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.saved import Scratch
from clickloom.operators.skew import split_hot

HOUR = 3600

# Instead of a number of rows from which a session is hot: ranges, for which no session is.
RANGES = -1


def session_key(session: str) -> dict[str, Column]:
    """The session as two columns without nulls, so that null is a session like any other."""
    return {
        "_session": F.coalesce(F.col(session).cast("string"), F.lit("")),
        "_no_session": F.col(session).isNull(),
    }


SESSION_KEY = ["_session", "_no_session"]


def previous_moment(
    moments: DataFrame,
    keys: Sequence[str],
    moment: str,
    slices: Sequence[int],
    previous: str = "previous",
    value: str | None = None,
) -> DataFrame:
    """Add the moment before each moment of the same key; null for the first one.

    ``moments`` has one row per key and moment (a whole number). ``slices`` are growing slice
    widths: a window only ever sees the moments of one slice, and the last moment of each slice is
    carried to the next one by the same method on the next level, with one row per slice.
    """
    value = value or moment
    if not slices:
        order = Window.partitionBy(*keys).orderBy(moment)
        return moments.withColumn(previous, F.lag(value).over(order))
    width, *wider = slices
    level = len(slices)
    start, last, carried = f"_slice_{level}", f"_last_{level}", f"_carried_{level}"
    sliced = moments.withColumn(start, F.col(moment) - F.pmod(F.col(moment), F.lit(width).cast("bigint")))
    order = Window.partitionBy(*keys, start).orderBy(moment)
    inside = sliced.withColumn(previous, F.lag(value).over(order))
    ends = sliced.groupBy(*keys, start).agg(F.max(value).alias(last))
    carry = previous_moment(ends, keys, start, wider, carried, last).select(*keys, start, carried)
    return (
        inside.join(carry, [*keys, start])
        .withColumn(previous, F.coalesce(F.col(previous), F.col(carried)))
        .drop(start, carried)
    )


def seconds_in_session(session: str, event_time: str, then_by: Sequence[str]) -> Column:
    """Whole seconds since the previous event of the session, 0 for the first one."""
    order = Window.partitionBy(session).orderBy(event_time, *then_by)
    second = F.unix_timestamp(F.col(event_time))
    return F.coalesce(second - F.unix_timestamp(F.lag(event_time).over(order)), F.lit(0))


def _same_as_before(column: pa.Array) -> np.ndarray:
    """For each value but the first whether it equals the one before it; null equals null."""
    now, before = column.slice(1), column.slice(0, len(column) - 1)
    both = pc.and_(pc.is_null(now), pc.is_null(before))
    return pc.or_kleene(pc.fill_null(pc.equal(now, before), False), both).to_numpy(zero_copy_only=False)


def _look_back(session: str, event_time: str, previous: str):
    """Rows of one range with the time of the row before, if that has the same session.

    ``_open`` marks the first row of a range, whose row before is elsewhere, ``_last`` the last one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.RecordBatch | None = None  # the last row so far, not sent yet
        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks().to_batches()[0]
            yield from sent(rows, not started, False)
            started, before = started or rows.num_rows > 1, rows.slice(max(0, rows.num_rows - 2))
        if before is not None:
            yield from sent(before, False, True) if before.num_rows > 1 else sent(before, True, True)

    def sent(rows: pa.RecordBatch, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
        """The rows that are complete: the first of a range only if asked, the last only at the end."""
        names = rows.schema.names
        sessions, times = rows.column(names.index(session)), rows.column(names.index(event_time))
        same = np.concatenate([[False], _same_as_before(sessions)])
        shifted = pa.concat_arrays([pa.nulls(1, times.type), times.slice(0, len(times) - 1)])
        found = pc.if_else(pa.array(same), shifted, pa.nulls(len(times), times.type))
        opened = np.zeros(len(times), bool)
        opened[0] = first
        ended = np.zeros(len(times), bool)
        ended[-1] = last
        whole = pa.RecordBatch.from_arrays([*rows.columns, found, pa.array(opened), pa.array(ended)], names=[*names, previous, "_open", "_last"])
        begin, end = (0 if first else 1), (len(times) if last else len(times) - 1)
        if end > begin:
            yield whole.slice(begin, end - begin)

    return run


def previous_by_ranges(
    events: DataFrame, session: str, event_time: str, then_by: Sequence[str], previous: str = "prev_event_time", ranges: int | None = None
) -> DataFrame:
    """Add the time of the event before in the session, null for its first one.

    Events are ordered by time, then by ``then_by``; null is a session and a time of its own and comes first.
    ``ranges`` is the number of tasks, the session's shuffle partitions unless given. Rows that agree in all of these
    columns stay together, so there should not be very many of them.
    """
    spark = events.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(dict.fromkeys([session, event_time, *then_by]))
    columns = [F.col(f"`{name}`") for name in keys]
    ordered = events.repartitionByRange(ranges, *columns).withColumn("_range", F.spark_partition_id()).sortWithinPartitions(*columns)
    kind = events.schema[event_time].dataType
    marks = [T.StructField(previous, kind), T.StructField("_open", T.BooleanType()), T.StructField("_last", T.BooleanType())]
    looked = ordered.mapInArrow(_look_back(session, event_time, previous), T.StructType([*ordered.schema.fields, *marks]))
    # Written, because ranges laid out again could be cut elsewhere.
    table = Scratch(events, "event-ranges").saved(looked)
    # One row for each range: what the next one that is not empty has to know.
    ends = table.filter("_last").select("_range", F.col(session).alias("_session"), F.col(event_time).alias("_time"))
    before = Window.orderBy("_range")
    carried = ends.select("_range", F.lag("_session").over(before).alias("_session"), F.lag("_time").over(before).alias("_time"))
    joined = table.alias("e").join(F.broadcast(carried).alias("c"), (F.col("e._range") == F.col("c._range")) & F.col("e._open"), "left")
    same = F.col("_open") & F.col(f"e.`{session}`").eqNullSafe(F.col("c._session"))
    time = F.when(same, F.col("c._time")).otherwise(F.col(f"e.`{previous}`"))
    return joined.select(*[F.col(f"e.`{name}`") for name in events.columns], time.alias(previous))


def time_spent(
    events: DataFrame,
    event_id: str,
    session: str = "user_session",
    event_time: str = "event_time",
    hot_rows: int | None = RANGES,
) -> DataFrame:
    """Add ``prev_event_time`` and ``time_spent`` to every event.

    Events of a session are ordered by time, then by ``event_id``, which is unique. The time spent
    is the difference of the whole seconds and belongs to the later event; the first event of a
    session has no previous time and spends 0. Sessions may be of any size, being cut into ranges. With ``hot_rows=None``
    each session is sorted in one task, without a table in between, for sessions known to be small; with a
    number, those of so many events are looked for and spread over many tasks.
    """
    if events.schema[event_time].dataType.typeName() == "timestamp_ntz":
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if hot_rows == RANGES:
        previous = previous_by_ranges(events, session, event_time, [event_id])
    else:
        cold, hot = split_hot(events, session, hot_rows)
        order = Window.partitionBy(session).orderBy(event_time, event_id)
        previous = cold.withColumn("prev_event_time", F.lag(event_time).over(order))
        if hot is not None:
            previous = previous.unionByName(_previous_in_hot_sessions(hot, event_id, session, event_time))
    spent = F.unix_timestamp(F.col(event_time)) - F.unix_timestamp("prev_event_time")
    return previous.withColumn("time_spent", F.coalesce(spent, F.lit(0)).cast("double"))


def _previous_in_hot_sessions(events: DataFrame, event_id: str, session: str, event_time: str) -> DataFrame:
    """Add ``prev_event_time`` without sorting a session in one task."""
    keyed = events.withColumns({**session_key(session), "_micros": F.unix_micros(F.col(event_time))})
    # One row per distinct time; among events at the same time only the first looks further back.
    times = (
        keyed.filter(F.col("_micros").isNotNull())
        .groupBy(*SESSION_KEY, "_micros")
        .agg(F.min(event_id).alias("_first"))
    )
    second = 1_000_000
    looked_up = previous_moment(times, SESSION_KEY, "_micros", [second, HOUR * second], "_before")
    lookup = looked_up.select(*SESSION_KEY, "_micros", "_first", "_before")
    joined = keyed.join(lookup, [*SESSION_KEY, "_micros"], "left")
    before = F.when(F.col(event_id) == F.col("_first"), F.col("_before")).otherwise(F.col("_micros"))
    return joined.select(
        *[F.col(f"`{name}`") for name in events.columns], F.timestamp_micros(before).alias("prev_event_time")
    )


def credited_seconds(
    events: DataFrame,
    session: str,
    event_time: str,
    carried: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Whole seconds spent, as one row per session and second with an event in it.

    Only the first event of a second can have a positive time, because the time counts whole
    seconds. So the events of a second shrink to that one event before the shuffle, and a session
    has at most one row per second however many events it holds. ``carried`` are the columns of
    that event to keep; ties in time are decided by ``tie_breakers``, then by ``carried``.
    """
    second = F.unix_timestamp(F.col(event_time))
    first = F.struct(*[F.col(name) for name in dict.fromkeys([event_time, *tie_breakers, *carried])])
    heads = (
        events.withColumns({**session_key(session), "_second": second})
        .filter(F.col("_second").isNotNull())
        .groupBy(*SESSION_KEY, "_second")
        .agg(F.min(first).alias("_head"))
    )
    placed = previous_moment(heads, SESSION_KEY, "_second", [HOUR], "_previous")
    return placed.filter(F.col("_previous").isNotNull()).select(
        *[F.col("_head").getField(name).alias(name) for name in carried],
        (F.col("_second") - F.col("_previous")).alias("time_spent"),
    )

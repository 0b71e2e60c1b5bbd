"""Counts per key, distinct counts, top-k and a one-pass profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.scalars import indicator
from clickloom.schemas import quoted

# The three counted event types.
EVENT_TYPES = {"views": "view", "carts": "cart", "purchases": "purchase"}

SESSION_COUNTS = {"views": "total_views", "carts": "total_carts", "purchases": "total_purchases"}
PRODUCT_COUNTS = {"views": "product_views", "carts": "product_carts", "purchases": "product_purchases"}


def event_counts(
    events: DataFrame,
    keys: Sequence[str],
    names: Mapping[str, str],
    event_types: Mapping[str, str] = EVENT_TYPES,
    event_type: str = "event_type",
) -> DataFrame:
    """Views, carts and purchases per key; ``names`` gives the output columns."""
    return events.groupBy(*keys).agg(
        *[F.sum(indicator(event_type, event_types[kind])).alias(name) for kind, name in names.items()]
    )


def session_totals(events: DataFrame, session: str = "user_session", **options) -> DataFrame:
    """Views, carts and purchases per session."""
    return event_counts(events, [session], SESSION_COUNTS, **options)


def session_product_counts(
    events: DataFrame,
    keys: Sequence[str] = ("user_session", "product_id", "user_id", "name"),
    **options,
) -> DataFrame:
    """Views, carts and purchases per session, product, user and product name."""
    return event_counts(events, keys, PRODUCT_COUNTS, **options)


def count_per(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and the exact number of distinct values of each column, null being a value.

    One pass: Spark makes column and value pairs distinct with map-side combine and a shuffle by
    pair, then adds up counts.
    """
    return df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_distinct(F.struct(quoted(name))).alias(f"distinct_{name}") for name in columns],
    )


def top_groups(df: DataFrame, key: str, k: int, count: str = "n") -> DataFrame:
    """The ``k`` keys with the most rows; ties go to the smaller key."""
    return count_per(df, [key], count).orderBy(F.desc(count), F.asc(key)).limit(k)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the given total order. They meet in one task, so ``n`` must be small."""
    return df.orderBy(*order).limit(n)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, null count, smallest and largest value of each column, in one pass."""
    columns = list(columns or df.columns)
    aggregates = [F.count("*").alias("n_rows")]
    for i, name in enumerate(columns):
        aggregates += [
            F.count_if(quoted(name).isNull()).alias(f"nulls_{i}"),
            F.min(quoted(name)).cast("string").alias(f"min_{i}"),
            F.max(quoted(name)).cast("string").alias(f"max_{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("n_rows"),
                F.col(f"nulls_{i}").alias("n_nulls"),
                F.col(f"min_{i}").alias("min_value"),
                F.col(f"max_{i}").alias("max_value"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))

"""Finding the keys that hold too many rows for one task.

Most keys are small and can be handled together in one task each. The few large ones are found
first, by counting, and take another way. Both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with this many rows is hot.
HOT_ROWS = 1_000_000

# So many keys are told apart while the hot ones are looked for.
TRACKED_KEYS = 1 << 15
MOST_HOT_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> list[int]:
    """Hashes of the keys with at least ``hot_rows`` rows, null being a key too.

    Every task keeps a sketch of the most frequent keys, of bounded size, and only the sketches are
    shuffled: one row for each task, however many keys there are. A key that the sketch may miss
    holds less than one row in nine thousand. Both ways of a key give the same result, so an
    approximate count does no harm. ``None`` looks for nothing.
    """
    if hot_rows is None:
        return []
    name = key.replace("`", "``")
    found = df.agg(F.expr(f"approx_top_k(xxhash64(`{name}`), {MOST_HOT_KEYS}, {TRACKED_KEYS})").alias("top")).first()["top"]
    return sorted(row["item"] for row in found or [] if row["count"] >= hot_rows)


def is_hot(key: str, hashes: Sequence[int]) -> Column:
    """Whether a row's key is among the hot ones."""
    if not hashes:
        return F.lit(False)
    # One expression text; thousands of literal columns would take seconds to make.
    name = key.replace("`", "``")
    return F.expr(f"xxhash64(`{name}`) IN ({', '.join(f'{value}L' for value in hashes)})")


def split_hot(df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys if there are any."""
    hashes = hot_keys(df, key, hot_rows)
    if not hashes:
        return df, None
    hot = is_hot(key, hashes)
    return df.filter(~hot), df.filter(hot)

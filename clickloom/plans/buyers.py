"""The users who buy most, and their purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.aggregates import top_groups
from clickloom.operators.rows import of_type

# top_groups yields k rows, so they may be broadcast up to this k.
MAX_BROADCAST_USERS = 100_000


def top_buyers(events: DataFrame, k: int = 3, purchase: str = "purchase") -> DataFrame:
    """``user_id, purchase_count`` of the ``k`` users with the most purchases."""
    return top_groups(of_type(events, purchase), "user_id", k, "purchase_count")


def top_buyer_rows(events: DataFrame, k: int = 3, purchase: str = "purchase") -> DataFrame:
    """All purchases of the top buyers."""
    users = top_buyers(events, k, purchase).select("user_id")
    if k <= MAX_BROADCAST_USERS:
        users = F.broadcast(users)
    return of_type(events, purchase).join(users, "user_id", "left_semi")

"""Connected components of links, by alternating stars on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages


def _lowest(edges: DataFrame) -> DataFrame:
    """The lowest neighbour of every node."""
    return edges.groupBy("node").agg(F.min("other").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for the nodes of ``links`` (columns a and b).

    Each round hooks neighbours to the lowest node around them, first the larger ones, then all; the number
    of rounds grows with the logarithm of a component's size. Minima are aggregated before they are shuffled,
    and the joins only bring one row for each node, so a node with very many links is no burden.
    """
    edges = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).filter("node > other").distinct()
    # No round makes more than two rows of a link.
    rows = 2 * links.count()
    edges, folder = stages.written(edges, "links", rows=rows)
    while True:
        if edges.join(edges.select(F.col("other").alias("node")), "node", "left_semi").isEmpty() and not _several(edges):
            return edges.select("node", F.col("other").alias("component")).union(
                edges.select("other", F.col("other").alias("component")).distinct()
            )
        both = edges.union(edges.select("other", "node"))
        low = _lowest(both).withColumn("low", F.least("node", "low"))
        large = both.join(low, "node").filter("other > node").select(F.col("other").alias("node"), F.col("low").alias("other"))
        large, middle = stages.written(large.distinct(), "links", rows=rows)
        low = _lowest(large)
        small = large.join(low, "node").filter("other > low").select(F.col("other").alias("node"), F.col("low").alias("other"))
        edges, after = stages.written(small.union(low).distinct(), "links", rows=rows)
        stages.dropped(folder)
        stages.dropped(middle)
        folder = after


def _several(edges: DataFrame) -> bool:
    """Whether some node still has more than one lower neighbour."""
    return not edges.groupBy("node").count().filter("count > 1").isEmpty()

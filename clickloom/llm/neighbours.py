"""Nearest neighbours by inner product, found in a low-dimensional stable projection.

Vectors get one more component that makes all of them equally long; then the largest inner product belongs
to the smallest distance. A Gaussian matrix (its distribution is 2-stable) projects them to fewer dimensions,
where a kd-tree gives a query's neighbours in growing distance, leaf by leaf. Each is verified with its
original vector. The squared projected distance, divided by the squared true one, follows a chi-square
distribution, so the search stops when a vector nearer than the worst one held would by now have been met
with the probability ``confidence``.

The index is cut into shards; equal vectors are one entry, with their smallest ids. Queries meet the shards
in blocks: every query sees every shard, and a task holds one block and one shard.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.shared import read_part

INDEX = "shard long, vectors binary, projected binary, leaves binary, ids binary, firsts binary"
FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    """``dimensions`` is even. ``shard_rows`` and ``block_rows`` bound what one task holds.

    With more dimensions the projected distance tells more of the true one, so fewer vectors are verified at the same
    recall. ``confidence`` is for the worst neighbour held; nearer ones are met earlier, so the recall is above it.
    """

    dimensions: int = 32
    confidence: float = 0.9
    leaf: int = 64
    shard_rows: int = 1 << 16
    block_rows: int = 256
    seed: int = 5


def chi_square(value: float, dimensions: int) -> float:
    """The distribution function, for an even number of dimensions."""
    half, term, total = value / 2, 1.0, 0.0
    for n in range(dimensions // 2):
        total += term
        term *= half / (n + 1)
    return 1 - math.exp(-half) * total


def stop_ratio(settings: Settings) -> float:
    """Squared projected over squared true distance at which the search may stop."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, settings.dimensions) < settings.confidence else (low, middle)
    return high


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _directions(width: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng([settings.seed, width]).standard_normal((width + 1, settings.dimensions))


def _tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points, and where the leaves of a kd-tree start in it."""
    order, starts, todo = np.arange(len(points)), [], [(0, len(points))]
    while todo:
        low, high = todo.pop()
        if high - low <= leaf:
            starts.append(low)
            continue
        own = order[low:high]
        axis = int(np.argmax(np.ptp(points[own], axis=0)))
        middle = (high - low) // 2
        order[low:high] = own[np.argpartition(points[own, axis], middle)]
        todo += [(low + middle, high), (low, low + middle)]
    return order, np.array([*sorted(starts), len(points)], np.int64)


def _build(scale: float, longest: float, settings: Settings):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(rows["vector"].tolist(), np.float64)
        scaled = vectors / scale
        rest = np.sqrt(np.maximum(longest - (scaled**2).sum(1), 0))
        projected = np.column_stack([scaled, rest]) @ _directions(vectors.shape[1], settings)
        order, leaves = _tree(projected, settings.leaf)
        ids = [np.sort(np.array(list(own), np.int64)) for own in rows["ids"].iloc[order]]
        firsts = np.concatenate([[0], np.cumsum([len(own) for own in ids])])
        parts = (vectors[order], projected[order], leaves, np.concatenate(ids), firsts)
        names = [field.split()[0] for field in INDEX.split(", ")][1:]
        row = {name: [np.ascontiguousarray(part).tobytes()] for name, part in zip(names, parts, strict=True)}
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], **row})

    return run


class _Shard:
    """One shard's vectors in the order of the leaves, with the box of each leaf."""

    def __init__(self, parts: dict[str, bytes], width: int, settings: Settings) -> None:
        part = lambda name, kind: np.frombuffer(parts[name], kind)
        self.vectors = part("vectors", np.float64).reshape(-1, width)
        self.projected = part("projected", np.float64).reshape(-1, settings.dimensions)
        self.leaves, self.ids, self.firsts = (part(name, np.int64) for name in ("leaves", "ids", "firsts"))
        self.longest = math.sqrt((self.vectors**2).sum(1).max())
        self.low = np.minimum.reduceat(self.projected, self.leaves[:-1])
        self.high = np.maximum.reduceat(self.projected, self.leaves[:-1])
        self.norms = (self.projected**2).sum(1)
        self.verified = 0

    def search(self, query: np.ndarray, place: np.ndarray, distance, count: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """The ``count`` vectors of the largest inner product that were met before the search stopped.

        ``place`` is the projected query; ``distance`` turns an inner product into a squared true distance.
        """
        gap = np.maximum(np.maximum(self.low - place, place - self.high), 0)
        bounds = (gap**2).sum(1)
        order = np.argsort(bounds, kind="stable")
        best, scores, limit = np.zeros(0, np.int64), np.zeros(0), np.inf
        # Few long steps in large shards, but short ones against their size, so that the limit is known early.
        at, step, most = 0, 2, max(2, len(order) // 16)
        while at < len(order) and bounds[order[at]] < limit:
            some = order[at : at + step]
            some = some[bounds[some] < limit]
            at, step = at + step, min(step * 2, most)
            sizes = self.leaves[some + 1] - self.leaves[some]
            points = np.repeat(self.leaves[some + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            if np.isfinite(limit):
                near = self.norms[points] - 2 * (self.projected[points] @ place) + place @ place
                points = points[near < limit]
            self.verified += len(points)
            best = np.concatenate([best, points])
            scores = np.concatenate([scores, self.vectors[points] @ query])
            if len(best) > count:
                top = self._top(query, best, scores, count)
                best, scores = best[top], scores[top]
            if len(best) == count:
                limit = ratio * distance(scores.min())
        # Summed anew, so that a score depends on its two vectors alone.
        return best, (self.vectors[best] * query).sum(1)

    def _top(self, query: np.ndarray, points: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
        """Places of the ``count`` best points by the score as it is in the result, then the smallest id."""
        edge = np.partition(scores, len(scores) - count)[len(scores) - count]
        # Products of a matrix differ from sums by their rounding, so what is that near the edge is summed.
        slack = 4 * len(query) * np.finfo(np.float64).eps * self.longest * math.sqrt((query**2).sum())
        near = np.flatnonzero(scores >= edge - slack)
        if len(near) == count:
            return near
        summed = (self.vectors[points[near]] * query).sum(1)
        return near[np.lexsort((self.ids[self.firsts[points[near]]], -summed))[:count]]


@functools.lru_cache(maxsize=1)
def _shard(folder: str, shard: int, width: int, settings: Settings) -> _Shard:
    table = read_part(folder, "shard", shard, [field.split()[0] for field in INDEX.split(", ")][1:])
    return _Shard({name: table[name][0].as_py() for name in table.column_names}, width, settings)


def _looks(shard: _Shard, width: int, scale: float, longest: float, count: int, settings: Settings):
    """The search of a shard for one query."""
    ratio, directions = stop_ratio(settings), _directions(width, settings)

    def look(query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = query / scale
        # The query is made as long as the longest vector; that changes no order.
        stretch = math.sqrt(longest) / math.sqrt((scaled**2).sum())
        place = np.append(scaled * stretch, 0.0) @ directions
        distance = lambda score: max(0.0, 2 * longest - 2 * score * stretch / scale**2)
        # One more than wanted, because the query itself may be among them.
        return shard.search(query, place, distance, count + 1, ratio)

    return look


def _search(folder: str, scale: float, longest: float, count: int, settings: Settings):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        width = int(key[2])
        shard = _shard(folder, int(key[0]), width, settings)
        look, out = _looks(shard, width, scale, longest, count, settings), []
        for query_id, vector in zip(rows["query_id"], rows["vector"], strict=True):
            best, scores = look(np.array(vector, np.float64))
            numbers = [shard.ids[shard.firsts[n] : shard.firsts[n + 1]] for n in best]
            ids = np.concatenate(numbers)
            each = np.repeat(scores, [len(own) for own in numbers])
            other = ids != query_id
            ids, each = ids[other], each[other]
            top = np.lexsort((ids, -each))[:count]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[top], "score": each[top]}))
        return pd.concat(out, ignore_index=True)

    return run


def nearest(
    df: DataFrame, queries: DataFrame, count: int = 20, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """The ``count`` nearest vectors found for each query: query_id, rank (from 1), vec_id, score.

    Both tables have the columns ``key`` and ``vector``. A query's candidates are all rows of ``df`` but those
    of its own id; the score is the inner product in double precision; ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without id.
    Vectors only meet vectors of their length. Repeated rows count once. If an id has several vectors, the
    best counts. An empty table on either side gives an empty result.
    """

    def prepared(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select(F.col(key).cast("long").alias(name), F.col(vector).cast("array<double>").alias("vector"))
        return rows.filter(F.col(name).isNotNull() & usable(F.col("vector"))).withColumn("width", F.size("vector"))

    # Only the smallest ids of a vector can be among the nearest. The limit is pushed below the shuffle.
    smallest = Window.partitionBy("vector").orderBy("id")
    entries = prepared(df, "id").withColumn("nth", F.dense_rank().over(smallest)).filter(F.col("nth") <= count + 1)
    entries = entries.groupBy("vector", "width").agg(F.collect_set("id").alias("ids"))
    entries, _ = stages.written(entries, "vectors")
    scale = entries.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if scale is None:
        return empty
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / scale) * (x / scale))
    longest = entries.agg(F.max(norm)).first()[0]
    widths = {row.width: row["count"] for row in entries.groupBy("width").count().collect()}
    # Shards of one vector length have numbers of their own.
    shards, first = F.lit(None).cast("long"), 0
    grid = []
    for width, rows in sorted(widths.items()):
        here = -(-rows // settings.shard_rows)
        shards = F.when(F.col("width") == width, F.lit(first) + F.pmod(F.xxhash64("vector"), F.lit(here))).otherwise(shards)
        grid.append((width, first, first + here - 1))
        first += here
    index = entries.withColumn("shard", shards).groupBy("shard").applyInPandas(_build(scale, longest, settings), INDEX)
    _, folder = stages.written(index, "vector-index", "shard")

    asked = prepared(queries, "query_id").dropDuplicates(["query_id", "vector"])
    blocks = max(1, -(-asked.count() // settings.block_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks)))
    spread = F.lit(None).cast("array<long>")
    for width, low, high in grid:
        spread = F.when(F.col("width") == width, F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))).otherwise(spread)
    asked = asked.filter(F.col("width").isin(list(widths))).withColumn("shard", F.explode(spread))
    # A group is little data and much work, so every group is a task; Spark would merge them by their size.
    asked = asked.repartition(blocks * first, "shard", "block", "width")
    found = asked.groupBy("shard", "block", "width").applyInPandas(_search(folder, scale, longest, count, settings), FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")

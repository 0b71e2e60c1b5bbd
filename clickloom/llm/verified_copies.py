"""Near copies of documents by banded MinHash, sequential Bayesian verification and exact sets.

1. A text is a set of word shingles. Equal sets are one class, so copies are no work later.
2. ``bands`` hashes of ``rows`` min-hash values each put a class into buckets. Classes of a bucket are
   candidates. Each is first compared with the smallest class of its bucket, which takes as many comparisons
   as the bucket has members and ties a large group of copies together.
3. A candidate pair is compared batch by batch of its signature. With a uniform prior, the posterior after m
   of n equal values says how likely the similarity still reaches the wanted one; below the chosen miss
   probability the pair is pruned.
4. Of the survivors the most similar partner of each class is verified on the full sets.
5. Members of a bucket that are still in different components are compared with each other in cells of
   bounded size, first by signature, then all survivors on their full sets. The largest component of a bucket is
   compared with the rest of the bucket, not with itself. A cell tells what hangs together, not its pairs.
   Large buckets with the same largest component mostly have the same members, so these are compared once, in a
   union of the buckets, wherever that takes fewer comparisons.

Nothing is capped: every pair of a bucket is either connected, pruned or verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import NOT_SPACE, mix, owners, slices, span_hashes, spans, text_bytes, window_hashes
from clickloom.llm.components import components
from clickloom.llm.jaccard import _whole_nodes as whole_cells

# Buckets with more than one in so many of all memberships are joined by broadcast; there are no more of them.
HOT_BUCKETS = 10_000
_PAIRS = 1 << 16
_COLUMNS = 4096
SIGNED = "key long, row long, a long, b long, n long, bands array<long>, low binary"
SURVIVORS = "a long, b long, equal int"
CELLS = "cell long, side int, crossed boolean, class long, component long, low binary"


@dataclass(frozen=True)
class Settings:
    """What counts as similar and how it is searched.

    Sets are similar if ``100 * shared >= percent * together``. A pair exactly there shares no band with a
    probability of ``(1 - s ** rows) ** bands``, 3 in a million. ``miss`` is the posterior probability of being similar
    below which a pair is pruned, ``batch`` the number of values compared at a time. ``cell`` bounds how
    many classes are compared in one place.
    """

    size: int = 4
    percent: int = 80
    rows: int = 5
    bands: int = 32
    batch: int = 32
    miss: float = 1e-7
    cell: int = 256
    seed: int = 29

    @property
    def length(self) -> int:
        return self.rows * self.bands

    def least_equal(self) -> list[tuple[int, int]]:
        """After so many values, so many must be equal for a pair to go on.

        Values are compared by one byte, so they are also equal by chance once in 256. A uniform prior makes
        the posterior a beta distribution, whose tail is that of a binomial one.
        """
        p = self.percent / 100
        p += (1 - p) / 256
        steps = []
        for n in range(self.batch, self.length + 1, self.batch):
            tail, least = 0.0, 0
            for m in range(n + 1):
                tail += math.comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
                if tail >= self.miss:
                    least = m
                    break
            steps.append((n, least))
        return steps


class _Sets:
    """The distinct shingles of each text of a slice, as sorted hashes.

    Words are runs of bytes that are no ASCII white space, A to Z in lower case. A text of fewer words than a
    shingle has one shingle of all of them; one without words has none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int) -> None:
        upper = (data >= 65) & (data <= 90)
        data = np.where(upper, data + 32, data).astype(np.uint8)
        starts, ends, firsts = spans(NOT_SPACE[data], offsets)
        words, hashes, owner = np.diff(firsts), span_hashes(data, starts, ends), owners(firsts)
        windows = window_hashes(hashes, size)
        inside = np.flatnonzero(owner[: len(windows)] == owner[size - 1 :]) if len(windows) else np.zeros(0, np.int64)
        short = np.flatnonzero((words > 0) & (words < size))
        whole = [window_hashes(hashes[firsts[n] : firsts[n + 1]], int(words[n]))[0] for n in short.tolist()]
        values = np.concatenate([windows[inside], np.array(whole, np.uint64)])
        of = np.concatenate([owner[inside], short])
        order = np.lexsort((values, of))
        values, of = values[order], of[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        self.values, self.owner = values[new], of[new]
        self.sizes = np.bincount(self.owner, minlength=len(offsets) - 1)
        self.edges = np.concatenate([[0], np.cumsum(self.sizes)])

    def digest(self, lane: int) -> np.ndarray:
        """A hash of each set, whatever the order of its shingles."""
        salted = mix(self.values ^ np.uint64(0x9E3779B97F4A7C15 if lane else 0xD1B54A32D192ED03))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(salted, dtype=np.uint64)])
        return (sums[self.edges[1:]] - sums[self.edges[:-1]]).view(np.int64)

    def signatures(self, length: int, seed: int) -> np.ndarray:
        """Min-hash values; zeros for empty sets."""
        source = np.random.default_rng(seed)
        factors = source.integers(0, 1 << 32, length, dtype=np.uint32) | np.uint32(1)
        terms = source.integers(0, 1 << 32, length, dtype=np.uint32)
        result, there = np.zeros((len(self.sizes), length), np.uint32), np.flatnonzero(self.sizes > 0)
        if len(there):
            short = (self.values >> np.uint64(32)).astype(np.uint32)
            for place in range(length):
                result[there, place] = np.minimum.reduceat(short * factors[place] + terms[place], self.edges[there])
        return result


def _sign(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SIGNED.split(", ")]
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last, some, ends in slices(data, offsets):
                sets, count = _Sets(some, ends, settings.size), last - first
                values = sets.signatures(settings.length, settings.seed)
                bands = np.tile(mix(np.arange(1, settings.bands + 1, dtype=np.uint64)), (count, 1))
                for n in range(settings.rows):
                    bands = mix(bands + values[:, n :: settings.rows])
                low = (values & np.uint32(0xFF)).astype(np.uint8)
                places = pa.array(np.arange(count + 1, dtype=np.int32) * settings.bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        batch.column(1).slice(first, count),
                        pa.array(sets.digest(0)),
                        pa.array(sets.digest(1)),
                        pa.array(sets.sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(places, pa.array(bands.view(np.int64).ravel())),
                        pa.array([row.tobytes() for row in low], pa.binary()),
                    ],
                    names=names,
                )

    return run


def _exact_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last, some, ends in slices(data, offsets):
                sets = _Sets(some, ends, size)
                lists = pa.ListArray.from_arrays(pa.array(sets.edges.astype(np.int32)), pa.array(sets.values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], names=["class", "shingles"])

    return run


def _signatures(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(text_bytes(column)[0].tobytes(), np.uint8).reshape(-1, length)


def _sequential(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (i, j) of signatures survive all batches, and their equal values."""
    alive, equal, begin = np.arange(len(i)), np.zeros(len(i), np.int32), 0
    for end, least in steps:
        equal[alive] += (left[i[alive], begin:end] == right[j[alive], begin:end]).sum(1, dtype=np.int32)
        alive, begin = alive[equal[alive] >= least], end
    return alive, equal[alive]


def _test_pairs(settings: Settings):
    """Pairs that survive, of rows a, b and both signatures."""
    steps = settings.least_equal()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_signatures(batch.column(n), settings.length) for n in (2, 3))
            rows = np.arange(batch.num_rows)
            alive, equal = _sequential(left, right, rows, rows, steps)
            if len(alive):
                kept = pa.array(alive)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept), pa.array(equal)], names=["a", "b", "equal"])

    return run


class _Cells:
    """Some whole cells: their rows and the pairs of different components that survive."""

    def __init__(self, batch: pa.RecordBatch, settings: Settings) -> None:
        self.cell, side, crossed, self.own, component = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(5))
        low, steps = _signatures(batch.column(5), settings.length), settings.least_equal()
        found, active, step = [], np.arange(len(self.cell)), 0
        while True:
            step += 1
            active = active[active + step < len(self.cell)]
            active = active[self.cell[active] == self.cell[active + step]]
            if not len(active):
                break
            for first in range(0, len(active), _PAIRS):
                i = active[first : first + _PAIRS]
                j = i + step
                fits = (component[i] != component[j]) & (~crossed[i] | (side[i] != side[j]))
                i, j = i[fits], j[fits]
                alive, _ = _sequential(low, low, i, j, steps)
                found.append(np.stack([i[alive], j[alive]]))
        self.pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _with_partners(settings: Settings):
    """Rows of the classes that have a pair to verify in their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_cells(batches):
            kept = np.unique(_Cells(batch, settings).pairs)
            if len(kept):
                yield batch.take(pa.array(kept))

    return run


def _shared(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many elements each two of some sets share, by products of parts of the table of sets by elements."""
    _, codes = np.unique(values, return_inverse=True)
    rows = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.argsort(codes, kind="stable")
    codes, rows = codes[order], rows[order]
    result = np.zeros((len(edges) - 1, len(edges) - 1), np.int64)
    for first in range(0, int(codes.max(initial=-1)) + 1, _COLUMNS):
        low, high = np.searchsorted(codes, [first, first + _COLUMNS])
        part = np.zeros((len(edges) - 1, _COLUMNS), np.float32)
        part[rows[low:high], codes[low:high] - first] = 1
        result += np.rint(part @ part.T).astype(np.int64)
    return result


def _tied(settings: Settings):
    """For each class with links in its cell, another one that these lead to. Survivors are verified exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_cells(batches):
            cells = _Cells(batch, settings)
            i, j = cells.pairs
            sets = batch.column(6)
            edges, values = sets.offsets.to_numpy(), sets.values.to_numpy(zero_copy_only=False)
            parent = list(range(len(cells.own)))

            def root(n: int) -> int:
                while parent[n] != n:  # noqa: B023
                    parent[n] = parent[parent[n]]  # noqa: B023
                    n = parent[n]  # noqa: B023
                return n

            # Cells one by one: the rows of a cell follow each other.
            begins = np.append(np.flatnonzero(np.concatenate([[True], cells.cell[1:] != cells.cell[:-1]])), len(cells.cell))
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            for first, last in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                some = slice(*np.searchsorted(i, [first, last]))
                if some.start == some.stop:
                    continue
                own = edges[first : last + 1]
                shared = _shared(values[own[0] : own[-1]], own - own[0])[i[some] - first, j[some] - first]
                sizes = np.diff(own)
                together = sizes[i[some] - first] + sizes[j[some] - first] - shared
                similar = 100 * shared >= settings.percent * together
                for x, y in zip(i[some][similar].tolist(), j[some][similar].tolist(), strict=True):
                    parent[root(x)] = root(y)
            tied = [n for n in range(len(parent)) if root(n) != n]
            if tied:
                columns = [pa.array(cells.own[tied]), pa.array(cells.own[[root(n) for n in tied]])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


class _Search:
    """The classes, their verified links, and the components these make."""

    def __init__(self, df: DataFrame, key: str, text: str, settings: Settings) -> None:
        self.settings = settings
        self.texts = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
        self.signed, self.signed_folder = stages.written(self.texts.mapInArrow(_sign(settings), SIGNED), "copy-signatures")
        some = self.signed.filter("n > 0").groupBy("a", "b", "n").agg(
            F.min(F.struct("key", "row")).alias("of"), F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"),
            F.first("bands").alias("bands"), F.first("low").alias("low"),
        )
        self.classes, self.folder = stages.written(some.withColumn("class", F.monotonically_increasing_id()), "copy-classes")
        self.folders = [self.signed_folder, self.folder]
        self.links: DataFrame | None = None
        self.groups = self.classes.select(F.col("class").alias("node"), F.col("class").alias("component")).limit(0)

    def _written(self, df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
        table, folder = stages.written(df, purpose, rows=rows)
        self.folders.append(folder)
        return table

    def members(self) -> DataFrame:
        """bucket, n, pivot, class of all buckets with two classes or more."""
        rows = self.classes.select("class", F.explode("bands").alias("bucket"))
        buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("pivot")).filter("n > 1")
        buckets = self._written(buckets, "copy-buckets")
        return self._written(self.with_buckets(rows, buckets, "n").select("bucket", "n", "pivot", "class"), "copy-members")

    def with_buckets(self, rows: DataFrame, buckets: DataFrame, size: str) -> DataFrame:
        """Rows with what ``buckets`` says of theirs; the few with very many rows are broadcast."""
        hot = F.col(size) > max(self.settings.cell, self.classes.count() * self.settings.bands // HOT_BUCKETS)
        large = F.broadcast(buckets.filter(hot))
        usual = rows.join(large.select("bucket"), "bucket", "left_anti").join(buckets.filter(~hot), "bucket")
        return rows.join(large, "bucket").unionByName(usual)

    def with_components(self, rows: DataFrame) -> DataFrame:
        """bucket, class and the component that the class is in so far."""
        own = self.groups.select(F.col("node").alias("class"), "component")
        return rows.join(own, "class", "left").select("bucket", "class", F.coalesce("component", "class").alias("component"))

    def open_buckets(self, rows: DataFrame) -> DataFrame:
        """bucket, m, main_n, main of the buckets with several components: their members, those of the largest
        component, and that component."""
        parts = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
        whole = self._written(parts, "copy-parts").groupBy("bucket").agg(
            F.sum("n").alias("m"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("most")
        ).filter("parts > 1")
        return self._written(whole.select("bucket", "m", F.col("most.n").alias("main_n"), F.col("most.component").alias("main")), "copy-open")

    def with_signatures(self, pairs: DataFrame) -> DataFrame:
        """a, b and both signatures. Many rows may share b, so it is joined while the rows are narrow."""
        low = self.classes.select("class", "low")
        pairs = pairs.join(low.select(F.col("class").alias("b"), F.col("low").alias("right")), "b")
        pairs = pairs.join(low.select(F.col("class").alias("a"), F.col("low").alias("left")), "a")
        return pairs.select("a", "b", "left", "right")

    def shingles(self, wanted: DataFrame) -> DataFrame:
        """The full sets of the classes in ``wanted``."""
        wanted = wanted.join(self.classes.select("class", F.col("of.key").alias("of_key"), F.col("of.row").alias("of_row")), "class")
        found = self.texts.join(wanted, F.col("row").eqNullSafe(F.col("of_row")) & F.col("key").eqNullSafe(F.col("of_key")))
        # Rows of one key and text may repeat; one of them is enough.
        one = found.groupBy("class").agg(F.first("text").alias("text"))
        return self._written(one.mapInArrow(_exact_sets(self.settings.size), "class long, shingles array<long>"), "copy-sets")

    def tie(self, links: DataFrame) -> None:
        """Add verified links."""
        self.links = links if self.links is None else self.links.union(links)
        self.groups = self._written(components(self.links), "copy-groups")

    def stars(self, members: DataFrame) -> DataFrame:
        """Compare every member with the smallest class of its bucket, and verify the best of these of each class.

        Returns all that survive."""
        pairs = members.filter("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
        alive = self._written(self.with_signatures(pairs).mapInArrow(_test_pairs(self.settings), SURVIVORS), "copy-survivors")
        best = self._written(alive.groupBy("a").agg(F.max_by("b", F.struct("equal", -F.col("b"))).alias("b")), "copy-pairs")
        sets = self.shingles(best.select(F.explode(F.array("a", "b")).alias("class")).distinct())
        both = best.join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("right")), "b")
        both = both.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("left")), "a")
        counted = both.select("a", "b", F.size(F.array_intersect("left", "right")).alias("shared"), (F.size("left") + F.size("right")).alias("sizes"))
        similar = F.expr(f"100L * shared >= {self.settings.percent}L * (sizes - shared)")
        self.tie(self._written(counted.filter(similar).select("a", "b"), "copy-links"))
        return alive

    def blocks(self) -> tuple[Column, Column]:
        """How many blocks the smaller components of a bucket and its largest one make."""
        half = self.settings.cell // 2
        return F.ceil((F.col("m") - F.col("main_n")) / half), F.ceil(F.col("main_n") / half)

    def unions(self, rows: DataFrame, whole: DataFrame) -> DataFrame:
        """Rows of large buckets with what ``whole`` says of theirs; the number of a union is that of its largest
        component."""
        rest, mains = self.blocks()
        spread = F.col("main_n") * rest + (F.col("m") - F.col("main_n")) * (rest + mains)
        large = self._written(self.with_buckets(rows, whole, "m"), "copy-large")
        once = large.select(F.col("main").alias("bucket"), "class", "component").distinct()
        sizes = once.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("component") == F.col("bucket")).alias("main_n"))
        apart = whole.groupBy("main").agg(F.sum(spread).alias("apart"))
        fewer = sizes.withColumn("main", F.col("bucket")).join(apart, "main").filter(spread <= F.col("apart"))
        fewer = self._written(fewer.select("bucket", "m", "main_n", "main"), "copy-unions")
        own = whole.join(fewer.select("main"), "main", "left_anti").select("bucket", "m", "main_n", "main")
        alone = self.with_buckets(large.select("bucket", "class", "component"), own, "m")
        return self.with_buckets(once, fewer, "m").unionByName(alone)

    def cells(self, members: DataFrame, alive: DataFrame) -> DataFrame | None:
        """Members of buckets that hold several components, in cells. Pairs of a bucket of their own that did not
        survive are done."""
        two = members.filter("n = 2")
        open_two = two.filter("class <> pivot").join(alive.select(F.col("a").alias("class"), F.col("b").alias("pivot")), ["class", "pivot"], "left_semi")
        rows = members.filter("n > 2").select("bucket", "class").union(two.join(open_two.select("bucket"), "bucket", "left_semi").select("bucket", "class"))
        rows = self.with_components(rows)
        whole = self.open_buckets(rows)
        if whole.isEmpty():
            return None
        few = F.col("m") <= self.settings.cell
        small, large = self.with_buckets(rows, whole.filter(few), "m"), self.unions(rows, whole.filter(~few))
        cells = small.select(F.col("bucket").alias("cell"), F.lit(0).alias("side"), F.lit(False).alias("crossed"), "class", "component")
        # Blocks of the main component are numbered below zero; they meet all others, but not each other.
        rest, mains = self.blocks()
        spread = F.xxhash64("bucket", "class")
        side = F.when(F.col("component") == F.col("main"), -1 - F.pmod(spread, mains)).otherwise(F.pmod(spread, rest))
        split = large.withColumns({"rest": rest, "mains": mains, "side": side})
        others = F.when(F.col("side") < 0, F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)).otherwise(
            F.concat(F.sequence(-F.col("mains"), F.lit(-1).cast("long")), F.sequence(F.lit(0).cast("long"), F.col("rest") - 1))
        )
        split = split.withColumn("other", F.explode(others))
        cell = F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other"))
        split = split.select(cell.alias("cell"), F.col("side").cast("int"), (F.col("side") != F.col("other")).alias("crossed"), "class", "component")
        rows = cells.union(split).join(self.classes.select("class", "low"), "class")
        return rows.select("cell", "side", "crossed", "class", "component", "low").repartition("cell").sortWithinPartitions("cell")

    def close(self, members: DataFrame, alive: DataFrame) -> None:
        """Verify what the cells find."""
        cells = self.cells(members, alive)
        if cells is None:
            return
        found = self._written(cells.mapInArrow(_with_partners(self.settings), CELLS), "copy-partners")
        rows = found.join(self.shingles(found.select("class").distinct()), "class")
        rows = rows.select("cell", "side", "crossed", "class", "component", "low", "shingles").repartition("cell").sortWithinPartitions("cell")
        self.tie(self._written(rows.mapInArrow(_tied(self.settings), "a long, b long"), "copy-ties"))


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``df``: key, ``n_shingles``, ``component`` and ``kept``.

    ``component`` is the smallest key that links lead to, through any number of them, and ``kept`` is true where it
    is the row's own. Keys are whole numbers; any other type is refused.

    Nulls and empty texts: no shingles, no links, kept. A row without key takes part; its component is the smallest
    key of its group, and without any it is null and the row is kept. Rows that share a key are documents of
    their own, so repeated rows are all kept or all dropped. Texts are read whole, however long. Ties do not
    matter: the result is the connected components. An empty table gives an empty one. Other columns are not
    read, so their names may clash.
    """
    stages.whole_keys(df, key)
    search = _Search(df, key, text, settings)
    members = search.members()
    if not members.isEmpty():
        search.close(members, search.stars(members))
    known = search.classes.select("class", "a", "b", "copies", "first")
    groups = search.groups.select(F.col("node").alias("class"), "component").join(known.select("class", "first"), "class")
    if search.links is not None:
        low = groups.groupBy("component").agg(F.min("first").alias("lowest"))
        groups = groups.join(low, "component").select("class", "lowest")
        known = known.join(groups, "class", "left").withColumn("lowest", F.coalesce("lowest", "first"))
    else:
        known = known.withColumn("lowest", F.col("first"))
    known = known.filter("copies > 1 OR lowest < first OR first IS NULL").select("a", "b", "lowest")
    rows = search.signed.select("key", "a", "b", F.col("n").alias("n_shingles"))
    alone = rows.filter("n_shingles = 0").withColumn("component", F.col("key")).select("key", "n_shingles", "component")
    tied = rows.filter("n_shingles > 0").join(known, ["a", "b"], "left")
    tied = tied.select("key", "n_shingles", F.coalesce("lowest", "key").alias("component"))
    result, _ = stages.written(alone.union(tied).withColumn("kept", F.col("key").eqNullSafe(F.col("component"))), "near-copies")
    for folder in search.folders:
        stages.dropped(folder)
    return result

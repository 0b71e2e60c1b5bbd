"""Similarity join of documents on word shingles by chosen paths, and what follows from its links.

Sets are represented by ``LENGTH`` min-hash tokens (place, value); two sets share a token with the
probability of their Jaccard similarity. A run descends a tree: at each node it samples places at random,
``1 / similarity`` of them on average, and sends every set into the child of each sampled place and the
set's value there. Similar sets go on together, others part. A node of few sets is compared by brute force,
a larger one is split again; what is still large at the last level is compared in blocks, so nothing is
left out. All runs go down together, and there are as many as the target recall needs.

Most pairs meet several times. Every set knows the nodes in which it is compared, so a pair is looked at in
the first one that it shares and nowhere else. Links therefore need not leave their node one by one: a node
tells each of its sets how many links it has there and with which other sets it hangs together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import WORD_BYTE, mix, owners, slices, span_hashes, spans, text_bytes, window_hashes
from clickloom.llm.components import components

LENGTH = 128
# Places of the first level are the bits of a long.
MOST_PLACES = 62
_PAIRS = 1 << 16
SIGNED = "key long, row long, a long, b long, words long, tokens binary, low binary, full binary"
WORK = (
    "node long, token int, side int, crossed boolean, origin long, class long, "
    "mask long, origins array<long>, tokens binary, low binary"
)
TIES = "class long, partners long, root long"
PAIRS = "a long, b long, shared long, together long"


@dataclass(frozen=True)
class Settings:
    """What counts as similar, and how the tree is built.

    ``recall`` holds for pairs just at ``similarity`` whose paths end within ``levels``; more similar pairs
    are found more surely. ``slack`` is how far a min-hash estimate may fall short of the similarity before a
    pair is not verified, in standard deviations.
    """

    size: int = 5
    similarity: float = 0.8
    recall: float = 0.999
    levels: int = 4
    largest_node: int = 2048
    slack: float = 3.3
    broadcast_rows: int = 500_000
    seed: int = 11

    @property
    def runs(self) -> int:
        """Runs after which a pair has met with the probability ``recall`` at the last level."""
        met = 1.0
        for _ in range(self.levels):
            met = 1 - math.exp(-met)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - met))

    @property
    def places(self) -> np.ndarray:
        """The places sampled at the roots of all runs, each once."""
        source = np.random.default_rng(self.seed)
        count = int(source.binomial(LENGTH, 1 / (self.similarity * LENGTH), self.runs).sum())
        if count > MOST_PLACES:
            raise ValueError(
                f"recall {self.recall} at similarity {self.similarity} takes {count} places, but a mask holds {MOST_PLACES}"
            )
        return source.permutation(LENGTH)[:count]

    @property
    def least_equal(self) -> int:
        """Equal places among ``LENGTH`` from which a pair is verified."""
        s = self.similarity
        return math.ceil(LENGTH * (s - self.slack * math.sqrt(s * (1 - s) / LENGTH)))


class Shingles:
    """Words and shingles of a slice of lower-cased texts.

    Words are runs of ASCII letters, digits and characters beyond ASCII. A text of fewer words than a shingle
    has one shingle of all of them; a text without words has none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int) -> None:
        starts, ends, self.firsts = spans(WORD_BYTE[data], offsets)
        self.words = np.diff(self.firsts)
        self.hashes = span_hashes(data, starts, ends)
        self.owner = owners(self.firsts)
        windows = window_hashes(self.hashes, size)
        inside = self.owner[: len(windows)] == self.owner[size - 1 :] if len(windows) else np.zeros(0, bool)
        counts = np.maximum(self.words - size + 1, 0)
        short = np.flatnonzero((self.words > 0) & (self.words < size))
        counts[short] = 1
        self.edges = np.concatenate([[0], np.cumsum(counts)])
        self.values = np.empty(self.edges[-1], np.uint64)
        whole = np.ones(len(self.values), bool)
        whole[self.edges[short]] = False
        self.values[whole] = windows[inside]
        for n in short.tolist():
            own = self.hashes[self.firsts[n] : self.firsts[n + 1]]
            self.values[self.edges[n]] = window_hashes(own, len(own))[0]

    def identity(self, lane: int) -> np.ndarray:
        """A hash of each text's words in their order."""
        place = np.arange(len(self.hashes)) - np.repeat(self.firsts[:-1], self.words)
        step = np.uint64(0x9E3779B97F4A7C15 if lane else 0xD1B54A32D192ED03)
        placed = mix(self.hashes + (place.astype(np.uint64) + np.uint64(1 + lane)) * step)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)])
        return (sums[self.firsts[1:]] - sums[self.firsts[:-1]]).view(np.int64)


def _signatures(edges: np.ndarray, values: np.ndarray, seed: int) -> np.ndarray:
    """Min-hash tokens of each set; the sets are not empty."""
    source = np.random.default_rng(seed)
    factors = source.integers(0, 1 << 32, LENGTH, dtype=np.uint32) | np.uint32(1)
    terms = source.integers(0, 1 << 32, LENGTH, dtype=np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    result = np.empty((len(edges) - 1, LENGTH), np.uint32)
    for place in range(LENGTH):
        result[:, place] = np.minimum.reduceat(short * factors[place] + terms[place], edges[:-1])
    return result


def signed(df: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """One row for each text: what identifies it, and its tokens; as a table in the shared folder."""
    places = settings.places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(pc.utf8_lower(batch.column(2)))
            for first, last, some, ends in slices(data, offsets):
                shingles = Shingles(some, ends, settings.size)
                full = np.zeros((last - first, LENGTH), np.uint32)
                there = np.flatnonzero(shingles.words > 0)
                if len(there):
                    edges = np.append(shingles.edges[there], shingles.edges[-1])
                    full[there] = _signatures(edges, shingles.values, settings.seed)
                tokens = np.ascontiguousarray(full[:, places])
                low = (full & np.uint32(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(shingles.identity(0)),
                        pa.array(shingles.identity(1)),
                        pa.array(shingles.words),
                        *(pa.array([row.tobytes() for row in table], pa.binary()) for table in (tokens, low, full)),
                    ],
                    names=[field.split()[0] for field in SIGNED.split(", ")],
                )

    rows = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    return stages.written(rows.mapInArrow(run, SIGNED), "signatures")[0]


def _first_level(count: int):
    """The nodes of the first level that a set goes to: one for each sampled place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _ = text_bytes(batch.column(1))
            values = np.frombuffer(data.tobytes(), np.uint32).reshape(-1, count)
            token = np.tile(np.arange(count, dtype=np.uint64), len(values))
            node = mix(values.ravel().astype(np.uint64) + ((token + np.uint64(1)) << np.uint64(32)))
            own = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.view(np.int64)), pa.array(token.astype(np.int32)), pa.array(np.repeat(own, count))],
                names=["node", "token", "class"],
            )

    return run


def _next_level(level: int, settings: Settings):
    """The children of a large node that a set goes to. The node's hash samples the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(int((1 << 64) / (settings.similarity * LENGTH)))
        salt = mix(np.arange(1, LENGTH + 1, dtype=np.uint64) + np.uint64(level << 16))
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            classes = batch.column(1).to_numpy(zero_copy_only=False)
            values = np.frombuffer(text_bytes(batch.column(2))[0].tobytes(), np.uint32).reshape(-1, LENGTH)
            for first in range(0, len(nodes), 4096):
                own = slice(first, first + 4096)
                row, place = np.nonzero(mix(nodes[own, None] ^ salt) < limit)
                child = mix(mix(nodes[own][row] ^ salt[place]) + values[own][row, place])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), pa.array(np.full(len(row), -1, np.int32)), pa.array(classes[own][row])],
                    names=["node", "token", "class"],
                )

    return run


class _Rows:
    """Sets in nodes, in the order of the nodes, as arrays."""

    def __init__(self, batch: pa.RecordBatch, count: int) -> None:
        column = {name: batch.column(n) for n, name in enumerate(batch.schema.names)}
        for name in ("node", "token", "side", "crossed", "origin", "class", "mask"):
            setattr(self, "set" if name == "class" else name, column[name].to_numpy(zero_copy_only=False))
        lengths = pc.list_value_length(column["origins"]).to_numpy(zero_copy_only=False)
        self.known = np.arange(max(1, int(lengths.max(initial=0)))) < lengths[:, None]
        self.origins = np.zeros(self.known.shape, np.int64)
        self.origins[self.known] = pc.list_flatten(column["origins"]).to_numpy(zero_copy_only=False)
        self.tokens = np.frombuffer(text_bytes(column["tokens"])[0].tobytes(), np.uint32).reshape(-1, count)
        self.low = np.frombuffer(text_bytes(column["low"])[0].tobytes(), np.uint8).reshape(-1, LENGTH)

    def pairs(self, least_equal: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of each node that are to be looked at here and whose estimate suffices."""
        active, step = np.arange(len(self.node)), 0
        while True:
            step += 1
            active = active[active + step < len(self.node)]
            active = active[self.node[active] == self.node[active + step]]
            if not len(active):
                return
            for first in range(0, len(active), _PAIRS):
                left = active[first : first + _PAIRS]
                right = left + step
                fits = self.set[left] != self.set[right]
                fits &= ~self.crossed[left] | (self.side[left] != self.side[right])
                left, right = left[fits], right[fits]
                near = (self.low[left] == self.low[right]).sum(1) >= least_equal
                left, right = left[near], right[near]
                here = self._first_here(left, right)
                if here.any():
                    yield left[here], right[here]

    def _first_here(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether this is the first node in which both are compared: those of the first level by their
        token, then the others by their number."""
        bits = np.int64(1) << np.arange(self.tokens.shape[1], dtype=np.int64)
        common = (self.tokens[left] == self.tokens[right]) & ((self.mask[left, None] & bits) != 0)
        first = np.where(common.any(1), common.argmax(1), -1)
        here = first == self.token[left]
        deep = np.flatnonzero(here & (first < 0))
        if len(deep):
            i, j = left[deep], right[deep]
            lowest, met = np.zeros(len(deep), np.int64), np.zeros(len(deep), bool)
            for n in range(self.origins.shape[1]):
                same = (self.origins[i, n, None] == self.origins[j]) & self.known[j]
                new = ~met & self.known[i, n] & same.any(1)
                lowest[new], met = self.origins[i[new], n], met | new
            here[deep] = met & (lowest == self.origin[i])
        return here


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches regrouped so that no node is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(nodes != nodes[-1])[-1]) + 1 if nodes[0] != nodes[-1] else 0
        if cut or (held and held[-1].column(0)[-1].as_py() != nodes[0]):
            ready = [*held, batch.slice(0, cut)] if cut else held
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _with_partners(count: int, least_equal: int):
    """Rows of the sets that have a pair to verify in their node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_nodes(batches):
            chosen = np.zeros(batch.num_rows, bool)
            for left, right in _Rows(batch, count).pairs(least_equal):
                chosen[left] = chosen[right] = True
            if chosen.any():
                yield batch.filter(pa.array(chosen))

    return run


def _verified(batch: pa.RecordBatch, count: int, settings: Settings) -> Iterator[tuple[int, int, int, int]]:
    """Links: pairs whose shingle sets are really similar, as rows of the batch, shared and together."""
    over, under = settings.similarity.as_integer_ratio()
    data, offsets = text_bytes(pc.utf8_lower(batch.column(batch.schema.names.index("text"))))
    sets: list[np.ndarray] = []
    for _, _, some, ends in slices(data, offsets):
        shingles = Shingles(some, ends, settings.size)
        sets += [np.unique(shingles.values[a:b]) for a, b in zip(shingles.edges[:-1], shingles.edges[1:], strict=True)]
    for left, right in _Rows(batch, count).pairs(settings.least_equal):
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            together = len(sets[i]) + len(sets[j]) - shared
            # 0.8 as a binary fraction is a hair above; a rounded comparison takes it as meant.
            if shared * under >= over * together or abs(shared / together - settings.similarity) < 1e-12:
                yield i, j, shared, together


def _tied(count: int, settings: Settings):
    """For each set of a node: the documents that it is linked with there, and the smallest set that links
    inside the node lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_nodes(batches):
            own, copies = (batch.column(batch.schema.names.index(name)).to_pylist() for name in ("class", "copies"))
            partners, parent = dict.fromkeys(range(len(own)), 0), list(range(len(own)))

            def root(n: int) -> int:
                while parent[n] != n:  # noqa: B023
                    parent[n] = parent[parent[n]]  # noqa: B023
                    n = parent[n]  # noqa: B023
                return n

            for i, j, _, _ in _verified(batch, count, settings):
                partners[i] += copies[j]
                partners[j] += copies[i]
                low, high = sorted((root(i), root(j)), key=own.__getitem__)
                parent[high] = low
            linked = [n for n, found in partners.items() if found]
            if linked:
                columns = [[own[n] for n in linked], [partners[n] for n in linked], [own[root(n)] for n in linked]]
                names = [field.split()[0] for field in TIES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)

    return run


def _paired(count: int, settings: Settings):
    """The links one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in PAIRS.split(", ")]
        for batch in _whole_nodes(batches):
            own = batch.column(batch.schema.names.index("class")).to_pylist()
            found = [(*sorted((own[i], own[j])), shared, together) for i, j, shared, together in _verified(batch, count, settings)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*found, strict=True)], names=names)

    return run


def _levels(classes: DataFrame, settings: Settings) -> DataFrame:
    """Sets in the nodes that are compared: node, token, side, crossed, origin, class."""
    count = len(settings.places)
    rows = classes.select("class", "tokens").mapInArrow(_first_level(count), "node long, token int, class long")
    parts = []
    for level in range(1, settings.levels + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
        # Written first, so that both sides of the join are shuffled for it alone and a hot node can be split.
        sizes, _ = stages.written(sizes, "node-sizes")
        rows, _ = stages.written(rows.join(sizes, "node"), "nodes")
        whole = rows.filter(F.col("sets") <= settings.largest_node)
        parts.append(whole.select("node", "token", F.lit(0).alias("side"), F.lit(False).alias("crossed"), F.col("node").alias("origin"), "class"))
        rows = rows.filter(F.col("sets") > settings.largest_node)
        if rows.isEmpty():
            break
        if level == settings.levels:
            parts.append(_blocks(rows, settings))
            break
        full = classes.select("class", "full")
        rows = rows.join(full, "class").select("node", "class", "full")
        rows = rows.mapInArrow(_next_level(level, settings), "node long, token int, class long")
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def _blocks(rows: DataFrame, settings: Settings) -> DataFrame:
    """A node that stays large, as pairs of blocks; every pair of its sets is in exactly one of them."""
    blocks = F.ceil(F.col("sets") * 2 / settings.largest_node)
    side = F.pmod(F.xxhash64("node", "class"), blocks)
    rows = rows.withColumns({"blocks": blocks, "side": side})
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    spread = rows.withColumn("other", other)
    node = F.xxhash64("node", F.least("side", "other"), F.greatest("side", "other"))
    return spread.select(
        node.alias("node"),
        F.lit(-1).alias("token"),
        F.col("side").cast("int").alias("side"),
        (F.col("side") != F.col("other")).alias("crossed"),
        F.col("node").alias("origin"),
        "class",
    )


@dataclass(frozen=True)
class Join:
    """What the join found.

    ``members`` has key, row, class, first, copies and whether it stands for its class; texts of one class have
    the same words. ``classes`` has each class with the first key and the number of its documents. ``ties`` has, for each class in each node
    where it has links, the documents linked there and a class that it hangs together with. ``pairs`` has the
    links between classes one by one, each once; it is only computed where it is used, and its rows grow with
    the square of a group.
    """

    members: DataFrame
    classes: DataFrame
    ties: DataFrame
    pairs: DataFrame


def similarity_join(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> Join:
    """Join the documents whose sets of word shingles are similar.

    Documents without key or without words take no part: they are in no class. Rows of one key and one text
    are one document; texts that share a key are documents of their own. Extra columns are not read, so their
    names may clash.
    """
    signatures = signed(df, settings, key, text)
    documents = signatures.filter("key IS NOT NULL AND words > 0").dropDuplicates(["key", "row", "a", "b"])
    ids = ["a", "b"]
    # Classes of equal word sequences; the smallest key stands for each.
    classes = documents.groupBy(*ids).agg(
        F.min("key").alias("class"), F.count(F.lit(1)).alias("copies"), F.min_by(F.struct("row", "tokens", "low", "full"), "key").alias("of")
    )
    classes = classes.withColumn("first", F.col("class"))
    classes, _ = stages.written(classes.select(*ids, "class", "first", "copies", "of.*"), "classes")
    if not classes.groupBy("class").count().filter("count > 1").isEmpty():
        # A key with several texts may stand for several classes; all but one get a number beyond any key.
        nth = F.row_number().over(Window.partitionBy("first").orderBy(*ids))
        beyond = F.xxhash64("first", *ids).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
        classes = classes.withColumn("class", F.when(nth == 1, F.col("first")).otherwise(beyond))
        classes, _ = stages.written(classes, "classes")
    count, narrow = len(settings.places), classes.select("class", "tokens", "low")
    fields = [field.split()[0] for field in WORK.split(", ")]
    nodes = _levels(classes, settings)
    masks = nodes.filter("token >= 0").groupBy("class").agg(F.expr("bit_or(shiftleft(1L, token))").alias("mask"))
    deep = nodes.filter("token < 0").groupBy("class").agg(F.sort_array(F.collect_set("origin")).alias("origins"))
    work = nodes.join(narrow.join(masks, "class", "left").join(deep, "class", "left"), "class")
    empty = {"mask": F.lit(0).cast("long"), "origins": F.array().cast("array<long>")}
    work = work.withColumns({name: F.coalesce(name, value) for name, value in empty.items()}).select(*fields)
    sorted_work = work.repartition("node").sortWithinPartitions("node")
    found, _ = stages.written(sorted_work.mapInArrow(_with_partners(count, settings.least_equal), WORK), "partners")
    # A class is not always its first key, so texts are found by the key and row that stand for it.
    texts = df.select(F.col(key).cast("long").alias("first"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    wanted = found.select("class").distinct().join(classes.select("class", "first", "row", "copies"), "class")
    wanted, _ = stages.written(wanted, "partner-classes", rows=found.count())
    if wanted.count() <= settings.broadcast_rows:
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, ["first", "row"]).dropDuplicates(["class"]).drop("first", "row")
    checked = found.join(texts, "class").repartition("node").sortWithinPartitions("node").select(*fields, "text", "copies")
    ties, _ = stages.written(checked.mapInArrow(_tied(count, settings), TIES), "ties")
    pairs = checked.mapInArrow(_paired(count, settings), PAIRS)
    known = classes.select(*ids, "class", "first", "copies", F.col("row").alias("of"))
    stands = ((F.col("key") == F.col("first")) & (F.col("row") == F.col("of"))).alias("stands")
    members = documents.select("key", "row", *ids).join(known, ids).select("key", "row", "class", "first", "copies", stands)
    rest = signatures.filter("key IS NULL OR words = 0").select("key", "row").distinct()
    rest = rest.select("key", "row", *[F.lit(None).cast("long").alias(name) for name in ("class", "first", "copies")], F.lit(True).alias("stands"))
    return Join(members.union(rest), classes.select("class", "first", "copies"), ties, pairs)


def linked_documents(join: Join) -> DataFrame:
    """One row for each document: key, row, class, ``group``, ``links`` and ``chosen``.

    ``group`` is the smallest key that links lead to, through any number of them; ``links`` counts the other
    documents that are similar to this one, its copies among them; ``chosen`` is true for one document of
    each group. A document in no class is its own group.
    """
    partners = join.ties.groupBy("class").agg(F.sum("partners").alias("partners"))
    groups = components(join.ties.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    # The smallest class of a component need not have its smallest key: numbers beyond any key stand for keys too.
    lowest = groups.join(join.classes, "class").groupBy("component").agg(F.min(F.struct("first", "class")).alias("low"))
    lowest = lowest.select("component", F.col("low.first").alias("lowest"), F.col("low.class").alias("leader"))
    groups = groups.join(lowest, "component").select("class", "lowest", "leader")
    result = join.members.join(partners, "class", "left").join(groups, "class", "left")
    links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("partners", F.lit(0))
    leads = F.coalesce(F.col("leader") == F.col("class"), F.lit(True))
    chosen = leads & F.col("stands")
    return result.select(
        "key", "row", "class", F.coalesce("lowest", "first", "key").alias("group"), links.alias("links"), chosen.alias("chosen")
    )


def one_of_each_group(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``df`` with one document of each group of similar ones: the one with the smallest key.

    Rows without key or without words stay. Of repeated rows of one key and one text one stays.
    """
    documents = linked_documents(similarity_join(df, key, text, settings))
    gone = documents.filter("NOT chosen").select(
        "key", F.col("row").alias("hash")
    )
    gone, _ = stages.written(gone, "similar-gone")
    rows = df.select(stages.wrapped(df), F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("hash"))
    if gone.count() <= settings.broadcast_rows:
        gone = F.broadcast(gone)
    kept = rows.join(gone, ["key", "hash"], "left_anti")
    ids = rows.filter("key IS NOT NULL").groupBy("key", "hash").count().filter("count > 1")
    if not ids.isEmpty():
        unknown = kept.filter("key IS NULL")
        kept = kept.filter("key IS NOT NULL").dropDuplicates(["key", "hash"]).union(unknown)
    return kept.select("row.*")

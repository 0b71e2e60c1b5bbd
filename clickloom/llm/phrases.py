"""Phrases of words that occur together more than by chance, from a weighted de Bruijn graph.

Nodes are pairs of words, edges are triples: the edge (x, y, z) leads from node (x, y) to node (y, z) and weighs
as much as the triple occurs. A piece of text ends in edges that lead to the end mark, (x, y, end) and
(x, end, end), so every word starts exactly one edge and shorter counts are flows: the occurrences of a pair
are what leaves its node, end included, and those of a word what leaves all nodes that begin with it.

1. Tasks add up the edges of some million words at a time. Edges are shuffled together with the others of their first word,
   as two lists a word, so its hash travels once; edges of frequent words are split by the second word and
   those of frequent pairs by the third.
2. Edges and nodes that weigh enough are kept. Where an edge is all that enters a node and another all that
   leaves it, both belong to one unary path; paths are compacted by pointer jumping, and each carries one weight.
3. A pair inside a path occurs nowhere but in its triples, so it is no phrase of its own. Other pairs are
   compared with the heaviest path that begins or ends in them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import mix, owners, slices, span_hashes, spans, text_bytes

END = 0
# Words whose edges are added up in a task before they are sent.
CHUNK = 1 << 21
# A task tells of words and pairs with one in so many of its words; what has one in HOT_SHARE of all is split.
TELL_SHARE, HOT_SHARE, SPLITS = 4096, 2000, 64
WORD, PAIR, TOTAL = 0, 1, 2
FACTS = "kind int, lang string, x long, y long, word string, n long"
EDGES = "x long, part int, weight long, ys array<long>, zs array<long>"
_ROWS = 1 << 16

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_INSIDE = ~_BREAK
_INSIDE[[32, 9]] = False


@dataclass(frozen=True)
class Settings:
    """A phrase occurs ``least`` times at least; it is dropped inside a longer one that has ``percent`` of its
    occurrences. ``top`` phrases are returned for each language."""

    least: int = 10
    percent: int = 50
    top: int = 2000
    scale: int = 1_000_000


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


class _Words:
    """The words of a slice of texts: where they are, their hashes, and whether the next one is in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]) -> None:
        upper = (data >= 65) & (data <= 90)
        self.data = np.where(upper, data + 32, data).astype(np.uint8)
        self.starts, self.ends, firsts = spans(_INSIDE[self.data], offsets)
        self.owner = owners(firsts)
        salts = np.array([_salt(lang) for lang in langs], np.uint64)
        hashes = mix(span_hashes(self.data, self.starts, self.ends) ^ salts[self.owner]) if len(self.starts) else np.zeros(0, np.uint64)
        hashes[hashes == END] = 1
        self.hashes = hashes
        broken = np.concatenate([[0], np.cumsum(_BREAK[self.data])])
        self.joined = np.zeros(len(hashes), bool)
        self.joined[:-1] = (self.owner[1:] == self.owner[:-1]) & (broken[self.starts[1:]] == broken[self.ends[:-1]])

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The edge that each word starts."""
        y, z = np.zeros_like(self.hashes), np.zeros_like(self.hashes)
        y[:-1] = np.where(self.joined[:-1], self.hashes[1:], END)
        z[:-1] = np.where(self.joined[:-1], y[1:], END)
        return self.hashes, y, z


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, list[str]]]:
    """Words of the texts in column 0 with the languages in column 1."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        langs = batch.column(1).to_pylist()
        for first, last, some, ends in slices(data, offsets):
            yield _Words(some, ends, langs[first:last]), langs[first:last]


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of bytes as strings."""
    sizes = ends - starts
    places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    source = np.repeat(starts - places[:-1], sizes) + np.arange(int(places[-1]))
    out = data[source] if len(source) else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by word with its text, counts of words by language, and pairs that are frequent in a slice."""
    names = [field.split()[0] for field in FACTS.split(", ")]

    def rows(kind, lang, x, y, word, n):
        none = pa.nulls(len(n), pa.string())
        columns = [pa.array(np.full(len(n), kind, np.int32)), lang, pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), word, pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays([none if c is None else c for c in columns], names=names)

    for words, langs in _sliced(batches):
        if not len(words.hashes):
            continue
        distinct, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
        lang = pa.array(langs, pa.string()).take(pa.array(words.owner[first]))
        zeros = np.zeros(len(distinct), np.uint64)
        yield rows(WORD, lang, distinct, zeros, _gathered(words.data, words.starts[first], words.ends[first]), counts)
        of = dict.fromkeys(langs, 0)
        for own, n in zip(langs, np.bincount(words.owner, minlength=len(langs)).tolist(), strict=True):
            of[own] += n
        zeros = np.zeros(len(of), np.uint64)
        yield rows(TOTAL, pa.array(list(of), pa.string()), zeros, zeros, None, np.array(list(of.values())))
        x, y, _ = words.edges()
        told = len(x) // TELL_SHARE
        often = np.isin(x, distinct[counts > told]) & (y != END)
        pairs, counts = np.unique(np.stack([x[often], y[often]], 1), axis=0, return_counts=True)
        pairs, counts = pairs[counts > told], counts[counts > told]
        if len(pairs):
            yield rows(PAIR, None, np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]), None, counts)


def _added(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct edges, by first word, and how often each is there."""
    rest = mix(y + mix(z))
    order = np.lexsort((rest, x))
    while True:
        a, b, c, r = x[order], y[order], z[order], rest[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (c[1:] == c[:-1])
        if np.array_equal(same, (a[1:] == a[:-1]) & (r[1:] == r[:-1])):
            break
        # Different edges share a hash: compare the words themselves.
        order, rest = np.lexsort((z, y, x)), np.arange(len(x), dtype=np.uint64)
        rest[order] = np.cumsum(np.concatenate([[0], ~((x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1]) & (z[order][1:] == z[order][:-1]))])).astype(np.uint64)
    at = np.flatnonzero(np.concatenate([[True], ~same]))
    return a[at], b[at], c[at], np.diff(np.append(at, len(a)))


def _local_edges(hot_words: np.ndarray, hot_pairs: np.ndarray):
    """Edges of a task, added up some million words at a time, as lists for each first word and weight."""
    pair_marks = mix(hot_pairs[:, 0] + mix(hot_pairs[:, 1]))
    names = [field.split()[0] for field in EDGES.split(", ")]

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        x, y, z, weight = _added(*(np.concatenate(column) for column in zip(*held, strict=True)))
        part = np.zeros(len(x), np.int64)
        often = np.flatnonzero(np.isin(x, hot_words))
        if len(often):
            some = y[often]
            by_third = np.isin(mix(x[often] + mix(some)), pair_marks)
            spread = mix(np.where(by_third, z[often], some) ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(SPLITS)
            part[often] = 1 + spread.astype(np.int64) + by_third * SPLITS
        group = (weight << 8) | part
        order = np.lexsort((y, group, x))
        x, y, z, group = x[order], y[order], z[order], group[order]
        new = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (group[1:] != group[:-1])]))
        edges = np.append(new, len(x))
        for first in range(0, len(new), _ROWS):
            own = new[first : first + _ROWS]
            low, high = int(own[0]), int(edges[min(first + _ROWS, len(new))])
            places = pa.array((edges[first : first + len(own) + 1] - low).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x[own].view(np.int64)),
                    pa.array((group[own] & 0xFF).astype(np.int32)),
                    pa.array(group[own] >> 8),
                    *(pa.ListArray.from_arrays(places, pa.array(column[low:high].view(np.int64))) for column in (y, z)),
                ],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for words, _ in _sliced(batches):
            if len(words.hashes):
                held.append(words.edges())
                count += len(words.hashes)
            if count >= CHUNK:
                yield from flush(held)
                held, count = [], 0
        if held:
            yield from flush(held)

    return run


def _facts_table(texts: DataFrame, settings: Settings) -> tuple[DataFrame, str]:
    facts = texts.mapInArrow(_facts, FACTS).groupBy("kind", "lang", "x", "y", "word").agg(F.sum("n").alias("n"))
    facts = facts.filter((F.col("kind") != WORD) | (F.col("n") >= settings.least))
    return stages.written(facts, "phrase-facts", "kind")


def _frequent(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words and pairs with more than one in ``HOT_SHARE`` of all words; there are no more of either."""
    total = facts.filter(F.col("kind") == TOTAL).agg(F.sum("n")).first()[0] or 0
    hot = facts.filter((F.col("n") * HOT_SHARE > total) & (F.col("kind") != TOTAL)).select("kind", "x", "y").collect()
    words = np.array([row.x for row in hot if row.kind == WORD], np.int64).view(np.uint64)
    pairs = np.array([(row.x, row.y) for row in hot if row.kind == PAIR], np.int64).reshape(-1, 2).view(np.uint64)
    return words, pairs


def graph(texts: DataFrame, facts: DataFrame, settings: Settings) -> tuple[DataFrame, str]:
    """Edges (kind 3), nodes (kind 2) and words (kind 1) of at least ``least`` occurrences: kind, x, y, z, f.

    ``texts`` has the columns text and lang. All three come from one shuffle of the edges.
    """
    local = texts.mapInArrow(_local_edges(*_frequent(facts)), EDGES).repartition("x", "part")
    single = local.select("x", "part", "weight", F.inline(F.arrays_zip("ys", "zs"))).withColumnsRenamed({"ys": "y", "zs": "z"})
    enough = F.col("f") >= settings.least
    none = F.lit(None).cast("long")
    edges = single.groupBy("x", "part", "y", "z").agg(F.sum("weight").alias("f")).filter(enough & (F.col("z") != END))
    # What is split is complete only after the parts are added.
    nodes = single.groupBy("x", "part", "y").agg(F.sum("weight").alias("f")).filter((enough | (F.col("part") > SPLITS)) & (F.col("y") != END))
    words = local.groupBy("x", "part").agg(F.sum(F.col("weight") * F.size(F.arrays_zip("ys", "zs"))).alias("f"))
    words = words.filter(enough | (F.col("part") > 0))
    kinds = [
        words.select(F.lit(1).alias("kind"), "x", none.alias("y"), none.alias("z"), "f"),
        nodes.select(F.lit(2).alias("kind"), "x", "y", none.alias("z"), "f"),
        edges.select(F.lit(3).alias("kind"), "x", "y", "z", "f"),
    ]
    return stages.written(kinds[0].union(kinds[1]).union(kinds[2]), "phrase-graph", "kind")


def _parts(table: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges, nodes and words of the graph, each once."""
    edges = table.filter("kind = 3").select("x", "y", "z", "f")
    nodes = table.filter("kind = 2").groupBy("x", "y").agg(F.sum("f").alias("f"))
    words = table.filter("kind = 1").groupBy("x").agg(F.sum("f").alias("f"))
    least = F.col("f") >= settings.least
    return edges, nodes.filter(least), words.filter(least)


def unitigs(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, list[str]]:
    """Unary paths of the graph: ``id``, ``words`` (hashes in order), ``f``, and the folders to drop.

    An edge and the next one hang together if each is all that passes the node between them. A path stays
    within a piece of one text, so it is never longer than that.
    """
    of = nodes.select("x", "y", F.col("f").alias("tail"))
    to = nodes.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("f").alias("head"))
    marked = edges.join(of, ["x", "y"]).join(to, ["y", "z"]).select(
        F.monotonically_increasing_id().alias("id"), "x", "y", "z", "f", (F.col("f") == F.col("tail")).alias("all_out"), (F.col("f") == F.col("head")).alias("all_in")
    )
    marked, folder = stages.written(marked, "phrase-edges")
    folders = [folder]
    before = marked.filter("all_in").select(F.col("id").alias("to"), F.col("y").alias("x"), F.col("z").alias("y"))
    after = marked.filter("all_out").select("id", "x", "y")
    linked, folder = stages.written(after.join(before, ["x", "y"]).select("id", "to"), "phrase-links")
    folders.append(folder)
    # Pointer jumping: each edge of a path points further and further back, to the first one in the end.
    heads = linked.select(F.col("to").alias("id")).join(linked.select("id"), "id", "left_anti")
    pointers = linked.withColumn("steps", F.lit(1).cast("long")).union(heads.select("id", F.col("id").alias("to"), F.lit(0).cast("long").alias("steps")))
    while True:
        pointers, folder = stages.written(pointers, "phrase-pointers")
        folders.append(folder)
        far = pointers.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        joined = pointers.join(far, "to")
        if joined.filter("more > 0").isEmpty():
            break
        pointers = joined.select("id", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps"))
    placed = marked.join(pointers, "id", "left").select(
        F.coalesce("to", "id").alias("path"), F.struct(F.coalesce("steps", F.lit(0).cast("long")).alias("step"), "x", "y", "z").alias("edge"), "f"
    )
    # Edges without a neighbour are paths of one edge and need no grouping.
    alone = placed.join(heads.select(F.col("id").alias("path")), "path", "left_anti")
    alone = alone.select(F.col("path").alias("id"), F.array("edge.x", "edge.y", "edge.z").alias("words"), "f")
    long = placed.join(heads.select(F.col("id").alias("path")), "path", "left_semi")
    long = long.groupBy("path").agg(F.sort_array(F.collect_list("edge")).alias("edges"), F.max("f").alias("f"))
    words = F.concat(F.array(F.col("edges")[0].x, F.col("edges")[0].y), F.transform("edges", lambda e: e.z))
    paths, folder = stages.written(alone.union(long.select(F.col("path").alias("id"), words.alias("words"), "f")), "phrase-paths")
    return paths, [*folders, folder]


def _score(a: Column, left: Column, right: Column, settings: Settings) -> Column:
    """floor(scale * a * a / (left * right)), exactly."""
    wide = lambda column: column.cast("decimal(15,0)")
    product = wide(a) * wide(a) * F.lit(settings.scale).cast("decimal(8,0)")
    return F.call_function("div", product, wide(left) * wide(right))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The best phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at ``. , ; : ! ?`` and line breaks, pieces into words at blanks and tabs, A to Z in lower
    case. A phrase of ``a`` occurrences scores ``a * a / (l * r)`` at its worst cut into a first part of
    ``l`` and a rest of ``r`` occurrences; of equal cuts the first counts. It is dropped if a longer phrase that contains
    it occurs ``percent`` of its times. ``n`` is the number of words of the language.

    Nulls: a null language is ``und``; a null text counts as empty, and empty texts hold no words. Texts are
    read whole, however long. Repeated rows count each time. Ties go to more occurrences, then to the phrase
    that comes first in the order of bytes. An empty table gives an empty one. Other columns are not read, so their
    names may clash. Counts must stay below 10^15. Words are told apart by 64 hash bits within the graph.
    """
    spark: SparkSession = df.sparkSession
    texts = df.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    facts, facts_folder = _facts_table(texts, settings)
    table, graph_folder = graph(texts, facts, settings)
    edges, nodes, words = _parts(table, settings)
    nodes, nodes_folder = stages.written(nodes, "phrase-nodes")
    paths, folders = unitigs(edges, nodes)
    folders += [facts_folder, graph_folder, nodes_folder]
    f = lambda name: F.col("f").alias(name)
    one = words.join(facts.filter(F.col("kind") == WORD).select("x", "lang", "word"), "x").select("x", "f", "lang", "word")
    one, folder = stages.written(one, "phrase-words")
    folders.append(folder)
    # Triples: the edges of the paths.
    places = F.sequence(F.lit(0), F.size("words") - 3)
    triples = paths.select("f", "words", F.explode(places).alias("i")).select(f("a"), *[F.col("words")[F.col("i") + k].alias("xyz"[k]) for k in range(3)])
    triples = triples.join(nodes.select("x", "y", f("xy")), ["x", "y"]).join(nodes.select(F.col("x").alias("y"), F.col("y").alias("z"), f("yz")), ["y", "z"])
    named = lambda name: one.select(F.col("x").alias(name), f(f"f{name}"), F.col("word").alias(f"w{name}"))
    triples = triples.join(one.select("x", f("fx"), F.col("word").alias("wx"), "lang"), "x").join(named("y"), "y").join(named("z"), "z")
    first, second = _score(F.col("a"), F.col("fx"), F.col("yz"), settings), _score(F.col("a"), F.col("xy"), F.col("fz"), settings)
    triples = triples.withColumns({"s1": first, "s2": second})
    later = F.col("s2") < F.col("s1")
    triples = triples.select(
        "lang", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"), "a", F.when(later, F.col("xy")).otherwise(F.col("fx")).alias("l"),
        F.when(later, F.col("fz")).otherwise(F.col("yz")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    # Pairs: nodes that are not inside a path, unless one that begins or ends there is nearly as frequent.
    last = F.size("words")
    ends = F.array(*[F.struct(F.col("words")[i].alias("x"), F.col("words")[i + 1].alias("y")) for i in (F.lit(0), last - 2)])
    heaviest = paths.select("f", F.inline(ends)).groupBy("x", "y").agg(F.max("f").alias("longer"))
    inner = paths.filter("size(words) > 3").select("words", F.explode(F.sequence(F.lit(1), last - 3)).alias("i"))
    inner = inner.select(F.col("words")[F.col("i")].alias("x"), F.col("words")[F.col("i") + 1].alias("y"))
    pairs = nodes.join(inner, ["x", "y"], "left_anti").join(heaviest, ["x", "y"], "left")
    pairs = pairs.filter(F.expr(f"longer IS NULL OR 100L * longer < {settings.percent}L * f")).select("x", "y", f("a"))
    pairs = pairs.join(one.select("x", f("l"), F.col("word").alias("wx"), "lang"), "x").join(one.select(F.col("x").alias("y"), f("r"), F.col("word").alias("wy")), "y")
    pairs = pairs.select("lang", F.concat_ws(" ", "wx", "wy").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r"), settings).alias("score"))
    # First the best of each of some parts of a language, so that no task meets what all others found.
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    parts = triples.union(pairs).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPLITS)))
    some = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= settings.top)
    best = Window.partitionBy("lang").orderBy(*order)
    ranked = some.drop("part").withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= settings.top)
    totals = facts.filter(F.col("kind") == TOTAL).select("lang", "n")
    result = ranked.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    result, _ = stages.written(result, "phrases")
    for folder in folders:
        stages.dropped(folder)
    return result

"""Word2Vec without a model in one place: skip-gram with negative sampling over a blocked vocabulary.

Words are spread over ``blocks`` by their hash, as words and as contexts. Vectors live in a table with one row
for each block. Pairs of words that occur within a window are counted and belong to the cell (word block, context block).
A round trains as many cells as there are blocks, no two of which share a word block or a context block, each in a
task of its own; after as many rounds as there are blocks every cell had its turn. A task reads its two blocks from the
shared folder and holds them and the pairs of one cell, the driver holds nothing but counts and a bitmap of at most 16 MB that tells most rare words
from the words of the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.vectors import DIMENSION
from clickloom.operators.saved import Scratch, read_folder, remove, saved, scratch, shuffles_freed

WORD, CONTEXT = 0, 1
BLOCKS = "kind int, block int, words binary, counts binary, vectors binary, squares binary"
# Each slice of the pairs reads all tokens, so there are so many at most.
_MOST_SLICES = 8
# The model's table in its folder.
MODEL = "vectors"
_BATCH = 2048
# How many noise words a batch draws for each one that counts for a pair.
_JOINT = 32
# So many vectors are in a packed row at most; runs up to this length are added place by place.
_PACKED, _SHORT = 8192, 64
# Of the bitmap: the bits for each word of the vocabulary, and how many there are at least and at most, as powers of 2.
_BITS_PER_WORD, _LEAST_BITS, _MOST_BITS = 64, 15, 27


@dataclass(frozen=True)
class BlockedSettings:
    """``block_words`` and ``cell_pairs`` bound what a training task holds, ``text_rows`` and ``head_words`` what a
    task that adds up the words of texts holds. Pairs are counted in slices of about ``slice_pairs`` occurrences, whose
    shuffles are on the disk one after another. The result depends on the settings and the text, not on the number of tasks."""

    min_count: int = 0
    vector_size: int = DIMENSION
    window: int = 5
    negatives: int = 5
    epochs: int = 1
    rate: float = 0.1
    seed: int = 42
    block_words: int = 50_000
    cell_pairs: int = 5_000_000
    text_rows: int = 1_000_000
    head_words: int = 20_000
    slice_pairs: int = 500_000_000


def _hashed(word: str) -> Column:
    return F.xxhash64(word)


def _block(word: str, blocks: int) -> Column:
    # The upper bits, so that the words of a block are as spread as all words are.
    return F.pmod(F.shiftrightunsigned(F.col(word), 20), F.lit(blocks)).cast("int")


def _block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(20)) % np.uint64(blocks)


@dataclass(frozen=True)
class _Known:
    """A bit for each value of the upper bits of a hash: a word without a bit is not in the vocabulary."""

    bits: np.ndarray
    power: int

    @classmethod
    def of(cls, vocabulary: DataFrame, size: int) -> _Known:
        power = min(max(_LEAST_BITS, (_BITS_PER_WORD * size).bit_length()), _MOST_BITS)
        place = F.shiftrightunsigned(_hashed("word"), 64 - power) + 1
        marks = vocabulary.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        bits = np.zeros((2**power >> 15, 4096), np.uint8)
        for row in marks.collect():
            bits[row["at"] - 1] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits.ravel(), power)

    def may_be(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes.view(np.uint64) >> np.uint64(64 - self.power)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all lists, and the list each is from; null lists have none."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lengths)


def _half_counts(
    tokens: DataFrame, words: str, window: int, known: _Known | None = None, slice_: int = 0, slices: int = 1
) -> DataFrame:
    """``w, c, n`` with w <= c: how often these words are at most ``window`` places apart; one of so many slices of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, text = _flat(batch.column(0))
            kept = np.ones(len(hashes), bool) if known is None else known.may_be(hashes)
            for apart in range(1, window + 1):
                both = (text[apart:] == text[:-apart]) & kept[apart:] & kept[:-apart]
                one, other = hashes[apart:][both], hashes[:-apart][both]
                if slices > 1:
                    mine = ((one + other).view(np.uint64) >> np.uint64(32)) % np.uint64(slices) == slice_
                    one, other = one[mine], other[mine]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, other)), pa.array(np.maximum(one, other))], names=["w", "c"])

    hashed = tokens.select(F.transform(words, lambda word: F.xxhash64(word)))
    return hashed.mapInArrow(run, "w long, c long").groupBy("w", "c").agg(F.count(F.lit(1)).alias("n"))


def _either_way(half: DataFrame) -> DataFrame:
    """``w, c, n`` for both orders of the words; a word beside itself is a pair either way."""
    same = F.array(F.struct("w", "c", (F.col("n") * 2).alias("n")))
    both = F.array(F.struct("w", "c", "n"), F.struct(F.col("c").alias("w"), F.col("w").alias("c"), "n"))
    return half.select(F.inline(F.when(F.col("w") == F.col("c"), same).otherwise(both)))


def pair_counts(tokens: DataFrame, words: str, window: int) -> DataFrame:
    """``w, c, n``: how often the words with these hashes are at most ``window`` places apart, either way."""
    return _either_way(_half_counts(tokens, words, window))


def _new_blocks(size: int, seed: int):
    """The first vectors of a block: small random ones for words, zeros for contexts."""

    def run(table: pa.Table) -> pa.Table:
        words, counts = (table.column(name).to_numpy() for name in ("w", "n"))
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        block = table.column("block")[0].as_py()
        first = (np.random.default_rng((seed, block)).random((len(words), size), np.float32) - 0.5) / size
        rows = [(WORD, first), (CONTEXT, np.zeros_like(first))]
        ones = np.full(len(words), 1e-6, np.float32)
        return pa.table(
            {
                "kind": pa.array([kind for kind, _ in rows], pa.int32()),
                "block": pa.array([block] * 2, pa.int32()),
                "words": [words.tobytes()] * 2,
                "counts": [counts.tobytes()] * 2,
                "vectors": [vectors.tobytes() for _, vectors in rows],
                "squares": [ones.tobytes()] * 2,
            }
        )

    return run


class _Block:
    def __init__(self, row: dict, size: int) -> None:
        self.row = row
        self.words, self.counts = np.frombuffer(row["words"], np.int64), np.frombuffer(row["counts"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float32).reshape(-1, size).copy()
        self.squares = np.frombuffer(row["squares"], np.float32).copy()

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words are, and which of them are there at all."""
        return _among(self.words, wanted)

    def step(self, rows: np.ndarray, gradient: np.ndarray, rate: float) -> None:
        """One step for the gradients of some rows, each slowed by what its row has moved already."""
        order = np.argsort(rows, kind="stable")
        begins = _begins(rows[order])
        distinct, total = rows[order[begins]], np.add.reduceat(gradient[order], begins, axis=0)
        self.squares[distinct] += np.einsum("md,md->m", total, total) / total.shape[1]
        self.vectors[distinct] -= (rate / np.sqrt(self.squares[distinct]))[:, None] * total

    def changed(self) -> dict:
        return self.row | {"vectors": self.vectors.tobytes(), "squares": self.squares.tobytes()}


def _begins(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _train(settings: BlockedSettings, turn: int, blocks: int, folder: str):
    """Train one cell: its two blocks, which are in the folder, and its pairs. Each cell has a row without pairs besides."""

    def run(pairs: pa.Table) -> pa.Table:
        names = [field.split()[0] for field in BLOCKS.split(", ")]
        cell, both = pairs.column("cell")[0].as_py(), {}
        for kind, block in (WORD, cell), (CONTEXT, (cell + turn) % blocks):
            found = read_folder(f"{folder}/at={kind * blocks + block}", names)
            if found is not None:
                both[kind] = _Block(found.to_pylist()[0], settings.vector_size)
        w, c, n = (pairs.column(name).to_numpy() for name in ("w", "c", "n"))
        if len(both) == 2 and n.any():
            words, contexts = both[WORD], both[CONTEXT]
            (i, known), (j, there) = words.places(w), contexts.places(c)
            kept = known & there & (n > 0)
            order = np.lexsort((c[kept], w[kept]))
            source = np.random.default_rng((settings.seed, turn, words.row["block"], contexts.row["block"]))
            order = order[source.permutation(len(order))]
            i, j, n = i[kept][order], j[kept][order], n[kept][order].astype(np.float32)
            noise = np.cumsum(contexts.counts.astype(np.float64) ** 0.75)
            drawn = _JOINT * settings.negatives
            for first in range(0, len(i), _BATCH):
                own = slice(first, first + _BATCH)
                a, b, weight = i[own], j[own], n[own, None]
                # All pairs of a batch meet the same noise words, each at a share of its weight.
                others = np.searchsorted(noise, source.random(drawn) * noise[-1])
                x, y, z = words.vectors[a], contexts.vectors[b], contexts.vectors[others]
                near = (_sigmoid(np.einsum("md,md->m", x, y)[:, None]) - 1) * weight
                far = _sigmoid(x @ z.T) * (weight / np.float32(_JOINT))
                words.step(a, near * y + far @ z, settings.rate)
                contexts.step(np.concatenate([b, others]), np.concatenate([near * x, far.T @ x]), settings.rate)
        kinds = {"int": pa.int32(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in BLOCKS.split(", "))])
        return pa.Table.from_pylist([block.changed() for block in both.values()], schema)

    return run


@dataclass(frozen=True)
class BlockedModel:
    """Word vectors as a table of blocks, and the words they stand for (``word, n``)."""

    blocks: DataFrame
    vocabulary: DataFrame
    count: int
    settings: BlockedSettings
    folder: str
    known: _Known
    size: int

    def vectors(self) -> DataFrame:
        """``word, vector`` of all words."""
        size = self.settings.vector_size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words, vectors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    hashes, flat = np.frombuffer(words, np.int64), np.frombuffer(vectors, np.float32)
                    places = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * size)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.ListArray.from_arrays(places, pa.array(flat))], names=["w", "vector"])

        found = self.blocks.select("words", "vectors").mapInArrow(run, "w long, vector array<float>")
        return self.vocabulary.withColumn("w", _hashed("word")).join(found, "w").select("word", "vector")

    def _head(self) -> np.ndarray:
        """Hashes of the most frequent words, ``head_words`` at most; all words of a power of 2 of occurrences or none."""
        power = F.length(F.bin("n"))
        total, least = 0, 65
        for row in sorted(self.vocabulary.groupBy(power.alias("power")).count().collect(), reverse=True):
            total += row["count"]
            if total > self.settings.head_words:
                break
            least = row["power"]
        found = self.vocabulary.filter(power >= least).select(_hashed("word").alias("w")).collect()
        return np.sort(np.array([row["w"] for row in found], np.int64))

    def transform(self, texts: DataFrame, words: str, vector: str) -> DataFrame:
        """Add the mean vector of the tokens in ``words``; unknown words count as zero, no words give zeros.

        Texts stay where they are: a task reads the vectors from the model's folder, those of the most frequent
        words once, of the others the blocks that its texts need, one block at a time for many texts. Nothing is
        shuffled or written, so the disk holds the model alone, however many texts there are.
        """
        head = self._head()
        found = self.blocks.mapInArrow(_in_head(head, self.settings.vector_size), "words binary, vectors binary")
        # The result reads this table, and goes with the model's folder.
        frequent = Scratch(texts, f"{self.folder.rsplit('/', 1)[-1]}-head")
        frequent.saved(found.coalesce(1))
        reader = _Reader(f"{frequent.folder}/{frequent.count}", self.folder, self.count, head, None if len(head) == self.size else self.known)
        hashes = F.transform(words, lambda word: F.xxhash64(word)).alias("_hashes")
        fields = T.StructType([*texts.schema.fields, T.StructField(vector, T.ArrayType(T.FloatType()))])
        return texts.select("*", hashes).mapInArrow(_means(reader, self.settings, texts.columns, vector), fields)


def _among(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where numbers are in ordered ones, and which of them are there at all."""
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return at, ordered[at] == wanted


def _in_head(head: np.ndarray, size: int):
    """The words of a block that are in the head, and their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, vectors in zip(batch.column("words").to_pylist(), batch.column("vectors").to_pylist(), strict=True):
                hashes = np.frombuffer(words, np.int64)
                kept = _among(head, hashes)[1]
                own = np.frombuffer(vectors, np.float32).reshape(-1, size)[kept]
                yield pa.RecordBatch.from_arrays([pa.array([hashes[kept].tobytes()]), pa.array([own.tobytes()])], names=["words", "vectors"])

    return run


@dataclass(frozen=True)
class _Reader:
    """Where a task finds the vectors: those of the head, and the blocks of all words (``known`` is none if the head is all)."""

    frequent: str
    blocks: str
    count: int
    head: np.ndarray
    known: _Known | None

    def _rows(self, folder: str, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        table = read_folder(folder, ["words", "vectors"])
        if table is None:
            return
        for words, vectors in zip(*(table.column(name) for name in ("words", "vectors")), strict=True):
            yield np.frombuffer(words.as_buffer(), np.int64), np.frombuffer(vectors.as_buffer(), np.float32).reshape(-1, size)

    def of_head(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The head's words, ordered, and their vectors."""
        found = list(self._rows(self.frequent, size))
        words, vectors = (np.concatenate(parts) for parts in zip(*found, strict=True))
        order = np.argsort(words)
        return words[order], vectors[order]

    def of_block(self, block: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same of a block; one without words has no folder."""
        return next(self._rows(f"{self.blocks}/{MODEL}/block={block}", size), (np.zeros(0, np.int64), np.zeros((0, size), np.float32)))

    def others(self, hashes: np.ndarray) -> np.ndarray:
        """Which words may be known but are not in the head."""
        return self.known.may_be(hashes) & ~_among(self.head, hashes)[1]


def _add(sums: np.ndarray, rows: np.ndarray, vectors: Iterator[np.ndarray]) -> None:
    """Add vectors, which come in parts, to the rows of sums; equal rows are beside each other."""
    first = 0
    for part in vectors:
        own = rows[first : first + len(part)]
        begins = _begins(own)
        lengths = np.diff(np.append(begins, len(own)))
        if lengths.max() > _SHORT:
            sums[own[begins]] += np.add.reduceat(part, begins, axis=0)
        else:
            for place in range(lengths.max()):
                at = begins[lengths > place]
                sums[own[at]] += part[at + place]
        first += len(part)


def _parts(count: int, step: int = 65536) -> Iterator[slice]:
    return (slice(first, min(first + step, count)) for first in range(0, count, step))


def _groups(batches: Iterator[pa.RecordBatch], rows: int, words: int) -> Iterator[pa.Table]:
    """The batches in tables of ``rows`` rows at most; a table that has ``words`` words gets no further batch."""
    held, n_rows, n_words = [], 0, 0
    for batch in batches:
        first = 0
        while first < batch.num_rows:
            part = batch.slice(first, rows - n_rows)
            held.append(part)
            first, n_rows = first + part.num_rows, n_rows + part.num_rows
            n_words += len(part.column("_hashes").flatten())
            if n_rows == rows or n_words >= words:
                yield pa.Table.from_batches(held)
                held, n_rows, n_words = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _add_block(sums: np.ndarray, texts: np.ndarray, at: np.ndarray, vectors: np.ndarray) -> None:
    """Add what a block gives to the sums: its vectors ``at`` these places, to these texts. Text by text, so that
    the sum of one does not depend on the others."""
    order = np.lexsort((at, texts))
    at, texts = at[order], texts[order]
    begins = _begins(texts)
    ends = np.append(begins[1:], len(texts))
    for own in _parts(len(begins), _PACKED):
        first, last = begins[own.start], ends[own.stop - 1]
        mine = np.zeros((own.stop - own.start, sums.shape[1]), np.float32)
        of = np.repeat(np.arange(len(mine)), ends[own] - begins[own])
        _add(mine, of, (vectors[at[first:last][some]] for some in _parts(last - first)))
        sums[texts[begins[own]]] += mine


def _means(reader: _Reader, settings: BlockedSettings, columns: list[str], vector: str):
    """Texts with their means: what the head's words give, and what the blocks add, in the order of the blocks."""
    size, rows, most = settings.vector_size, max(1, settings.text_rows // 4), 4 * settings.text_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = None
        for texts in _groups(batches, rows, most):
            words, known = frequent = frequent or reader.of_head(size)
            sums, counts = np.zeros((len(texts), size), np.float32), np.zeros(len(texts), np.int64)
            rest, first = [], 0
            for chunk in texts.column("_hashes").chunks:
                hashes, text = _flat(chunk)
                counts[first : first + len(chunk)] = np.bincount(text, minlength=len(chunk))
                at, kept = _among(words, hashes)
                at = at[kept]
                _add(sums, text[kept] + first, (known[at[own]] for own in _parts(len(at))))
                if reader.known is not None:
                    other = reader.others(hashes)
                    rest.append((hashes[other], text[other] + first))
                first += len(chunk)
            if rest:
                hashes, text = (np.concatenate(parts) for parts in zip(*rest, strict=True))
                blocks = _block_of(hashes, reader.count)
                for block in np.unique(blocks):
                    mine = np.flatnonzero(blocks == block)
                    words_there, there = reader.of_block(int(block), size)
                    at, kept = _among(words_there, hashes[mine])
                    if kept.any():
                        _add_block(sums, text[mine[kept]], at[kept], there)
            sums /= np.maximum(counts, 1)[:, None].astype(np.float32)
            places = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * size)
            whole = texts.select(columns).append_column(vector, pa.ListArray.from_arrays(places, pa.array(sums.ravel())))
            yield from whole.to_batches(max_chunksize=_PACKED)

    return run


def fit(tokens: DataFrame, settings: BlockedSettings, words: str) -> BlockedModel:
    """Train on every row of ``tokens``, arrays of words.

    Words with fewer than ``min_count`` occurrences have no vector and train none. Equal hashes of two words would make
    them one; with 64 bits that is improbable below a billion words.
    """
    if not tokens.schema[words].dataType.simpleString() == "array<string>":
        raise TypeError(f"{words} must be arrays of words")
    keeper = Scratch(tokens, "word2vec")
    with scratch(tokens, "word2vec-rounds") as own, shuffles_freed(tokens.sparkSession):
        counted = tokens.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        vocabulary = keeper.saved(counted.filter(F.col("n") >= settings.min_count))
        counted = vocabulary.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("occurrences")).first()
        size, occurrences = counted["words"], counted["occurrences"]
        if not size:
            raise ValueError(f"no word occurs {settings.min_count} times; lower min_count")
        known = _Known.of(vocabulary, size)
        slices = min(math.ceil(occurrences * settings.window / settings.slice_pairs), _MOST_SLICES)
        halves = [own.saved(_half_counts(tokens, words, settings.window, known, n, slices)) for n in range(slices)]
        half = reduce(DataFrame.unionByName, halves)
        n_pairs = 2 * half.count()
        blocks = max(math.ceil(size / settings.block_words), math.ceil(math.sqrt(n_pairs / settings.cell_pairs)), 1)
        shift = F.pmod(_block("c", blocks) - _block("w", blocks), F.lit(blocks))
        # A pair and its other order belong to rounds that are equally far from the first. In order, words take less room.
        pairs = own.saved(half.withColumn("apart", F.least(shift, blocks - shift)).sortWithinPartitions("apart", "w"), "apart")
        for n in range(slices):
            remove(f"{own.folder}/{n + 1}")
        at = (F.col("kind") * blocks + F.col("block")).alias("at")
        spread = vocabulary.select(_hashed("word").alias("w"), "n").withColumn("block", _block("w", blocks))
        own.saved(spread.groupBy("block").applyInArrow(_new_blocks(settings.vector_size, settings.seed), BLOCKS).select("*", at), "at")
        # A row for each cell, so that one without pairs hands on its blocks as well.
        cells = tokens.sparkSession.range(blocks).select(*[F.lit(0).cast("long").alias(name) for name in ("w", "c", "n")], F.col("id").cast("int").alias("cell"))
        for turn in range(settings.epochs * blocks):
            now = turn % blocks
            mine = _either_way(pairs.filter(F.col("apart") == min(now, blocks - now))).filter(shift == now)
            dealt = mine.withColumn("cell", _block("w", blocks)).unionByName(cells).repartitionById(blocks, "cell")
            before = f"{own.folder}/{own.count}"
            table = own.saved(dealt.groupBy("cell").applyInArrow(_train(settings, turn, blocks, before), BLOCKS).select("*", at), "at")
            remove(before)
        # A folder for each block, which tasks read by themselves.
        kept = saved(table.filter(F.col("kind") == WORD).select("words", "vectors", "block"), f"{keeper.folder}/{MODEL}", "block")
        return BlockedModel(kept, vocabulary, blocks, settings, keeper.folder, known, size)

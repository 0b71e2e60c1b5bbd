"""Best-fit packing of token pieces into sequences of one size.

Best fit decreasing looks at lengths alone, so it runs on their histogram, which never has more entries than
a sequence has tokens. A segment tree over remaining capacities finds the tightest open sequences; all those
of one capacity that were filled alike are handled as one run. The result is the packing that placing the
documents one by one, longest first, would give, for any number of documents. Every piece then finds its
place by its rank among the pieces of its length; pieces are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import slices, text_bytes
from clickloom.llm.shared import read_part
from clickloom.llm.tokens import SLICE, encoder

_ROWS = 1000
PIECES = "key long, piece int, start long, length long, ids binary, part long, nth long"
PLACED = "key long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class OpenSequences:
    """Runs of open sequences by remaining capacity, over a segment tree that knows which capacities occur."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, first: int, count: int) -> None:
        """``count`` sequences from number ``first`` on have so much room."""
        if not capacity or not count:
            return
        self.runs[capacity].append((first, count))
        node = capacity + self.leaves
        while node and not self.tree[node]:
            self.tree[node] = True
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that occurs; logarithmic in the sequence size."""
        node = length + self.leaves
        if self.tree[node]:
            return length
        while node > 1:
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def take(self, capacity: int) -> tuple[int, int]:
        """Remove and return one run of that capacity."""
        run = self.runs[capacity].pop()
        node = capacity + self.leaves
        if not self.runs[capacity]:
            self.tree[node] = False
            node >>= 1
            while node:
                self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]
                node >>= 1
        return run


def best_fit_decreasing(histogram: dict[int, int], size: int) -> np.ndarray:
    """Where the pieces of each length go, as runs ordered by length and rank.

    Columns: length, first rank, pieces in each sequence, first sequence, offset. A run reaches up to the
    next one's first rank.
    """
    opened, sequences, result = OpenSequences(size), 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = opened.tightest(length)
            if capacity is None:
                capacity, each = size, size // length
                first, count = sequences, -(-left // each)
                sequences += count
            else:
                each = capacity // length
                first, count = opened.take(capacity)
            result.append((length, rank, each, first, size - capacity))
            full = min(count, left // each)
            opened.add(capacity - each * length, first, full)
            rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if left and count:  # less than a sequence can hold is left
                opened.add(capacity - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            opened.add(capacity, first, count)
    return np.array(sorted(result), np.int64).reshape(-1, 5)


def pieces(df: DataFrame, tokenizer: str, end_id: int, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of at most ``size`` ids, in a table in the shared folder.

    A longer document is cut from its end, so its first piece may be shorter. ``part`` and ``nth`` number a
    piece among those of its length that the same task wrote.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        encode = encoder(tokenizer)
        kind = "<u2" if encode.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        for batch in batches:
            keys = batch.column(0)
            data, offsets = text_bytes(batch.column(1))
            for first, last, some, places in slices(data, offsets, SLICE):
                ids, starts = encode.encode(some, places)
                ids = np.insert(ids, starts[1:], np.uint32(end_id)).astype(kind)
                counts = np.diff(starts) + 1
                begins = np.cumsum(counts) - counts
                number = -(-counts // size)
                owner = np.repeat(np.arange(len(counts)), number)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                stop = counts[owner] - (number[owner] - 1 - piece) * size
                start = np.maximum(stop - size, 0)
                lengths = stop - start
                nth = np.empty(len(owner), np.int64)
                order = np.argsort(lengths, kind="stable")
                kinds, at, many = np.unique(lengths[order], return_index=True, return_counts=True)
                nth[order] = np.arange(len(order)) - np.repeat(at, many) + np.repeat(seen[kinds], many)
                seen[kinds] += many
                # Pieces follow each other without a gap, and so do their bytes.
                edges = np.append(begins[owner] + start, len(ids)) * ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(first, last - first).take(pa.array(owner)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(lengths),
                        _binary(ids, edges),
                        pa.array(np.full(len(owner), part, np.int64)),
                        pa.array(nth),
                    ],
                    names=["key", "piece", "start", "length", "ids", "part", "nth"],
                )

    return stages.written(rows.mapInArrow(cut, PIECES), "pieces")[0]


def place(cut: DataFrame, size: int) -> DataFrame:
    """Every piece with the sequence and the offset that best fit decreasing gives it."""
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces"))
    counts, _ = stages.written(counts, "piece-counts")
    # At most ``size`` rows come to the driver.
    histogram = {row.length: row.pieces for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    runs = best_fit_decreasing(histogram, size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.select("part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    _, bases = stages.written(ranked.repartition("part"), "piece-ranks", "part")
    names = [name.split()[0] for name in PLACED.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = (runs[:, 0] << 44) + runs[:, 1]
        known: dict[int, np.ndarray] = {}
        for batch in (some.slice(n, _ROWS) for some in batches for n in range(0, some.num_rows, _ROWS)):
            rows = {name: batch.column(n) for n, name in enumerate(batch.schema.names)}
            length, nth = (rows[name].to_numpy(zero_copy_only=False) for name in ("length", "nth"))
            parts = rows["part"].to_numpy(zero_copy_only=False)
            rank = np.empty(len(parts), np.int64)
            for part in np.unique(parts).tolist():
                if part not in known:
                    table = read_part(bases, "part", part, ["length", "base"])
                    known = {part: np.zeros(size + 1, np.int64)}
                    known[part][table["length"].to_numpy()] = table["base"].to_numpy()
                own = parts == part
                rank[own] = known[part][length[own]] + nth[own]
            run = runs[np.searchsorted(firsts, (length << 44) + rank, "right") - 1]
            nth_in_run = rank - run[:, 1]
            rows["sequence_id"] = pa.array(run[:, 3] + nth_in_run // run[:, 2])
            rows["offset"] = pa.array(run[:, 4] + nth_in_run % run[:, 2] * length)
            rows["ids"] = _widened(rows["ids"], length)
            yield pa.RecordBatch.from_arrays([rows[name] for name in names], names=names)

    return cut.mapInArrow(find, PLACED)


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes between the edges, as a column."""
    parts = [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, parts)


def _widened(ids: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Ids as little-endian unsigned 32-bit numbers."""
    data, offsets = text_bytes(ids)
    width = len(data) // max(1, int(lengths.sum()))
    if width == 4:
        return ids
    return _binary(np.ascontiguousarray(data).view("<u2").astype("<u4"), 2 * offsets)


def pack(df: DataFrame, tokenizer: str, end_id: int, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack the tokens of all documents into as few sequences of ``size`` ids as best fit decreasing needs.

    One row for each piece: key, piece, start, length, ids (little-endian unsigned 32-bit numbers),
    sequence_id (from 0), offset (gapless from 0 in each sequence).

    Nulls: a null key stays null, a null text counts as empty and gives ``end_id`` alone. Repeated rows are
    packed as often as they come. Pieces of one length are interchangeable, so ties need no rule. Other
    columns play no part. An empty table gives no rows.
    """
    return place(pieces(df, tokenizer, end_id, size, key, text), size)

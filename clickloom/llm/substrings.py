"""Removal of word windows that an earlier document has, with a count-min prefilter.

Three passes over the texts, none of which shuffles them:

1. Every task sketches its windows. A sketch has two rows of cells; each row is kept as the sorted cells
   that are not zero, cut into blocks of the cell range. The blocks of all tasks meet and are added up. A
   block tells each task which of the task's own cells hold two or more: the merged sketch is never in one
   place, and its width follows the input.
2. Windows whose both cells hold two or more are candidates: a count-min sketch never counts too little, so
   no repeated window is missing. Candidates are grouped exactly, by 96 bits of two independent hashes, and
   every task learns for its own candidates the smallest document that has them.
3. Words that such a window covers go.

Each task sends a window once, however often it holds it, so a passage that a third of all documents share
is as light as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import NOT_SPACE, mix, owners, slices, span_hashes, spans, text_bytes, window_hashes
from clickloom.llm.shared import read_part

WINDOW = 13
_FLUSH = 1 << 20
_PER_BLOCK = 1 << 20
_ROWS = 2
_SECOND = np.uint64(0xA0761D6478BD642F)

SKETCH = "lane int, block long, part long, cells binary, twice binary"
CELLS = "part long, lane int, block long, cells binary"
CANDIDATES = "block long, part long, hash binary, check binary, key binary, keyed binary, several binary"
FIRSTS = "part long, hash binary, check binary, key binary"


def _deltas(values: np.ndarray) -> bytes:
    """Ascending numbers as steps of 2 or 4 bytes, after a byte that tells which."""
    steps = np.diff(values, prepend=np.zeros(1, values.dtype))
    narrow = not len(steps) or int(steps.max()) < 1 << 16
    return (b"\2" if narrow else b"\4") + steps.astype("<u2" if narrow else "<u4").tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1), dtype=np.uint64)


class _Set:
    """Membership in sorted 64-bit numbers; a table of bits answers most of it."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(values & np.uint64(len(self.bits) - 1)).astype(np.int64)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted are there, and where."""
        maybe = np.flatnonzero(self.bits[(wanted & np.uint64(len(self.bits) - 1)).astype(np.int64)])
        at = np.searchsorted(self.values, wanted[maybe])
        at[at == len(self.values)] = 0
        there = self.values[at] == wanted[maybe] if len(self.values) else np.zeros(len(maybe), bool)
        return maybe[there], at[there]


class _Windows:
    """The words and windows of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int) -> None:
        self.data, self.size = data, size
        self.starts, self.ends, self.firsts = spans(NOT_SPACE[data], offsets)
        self.owner = owners(self.firsts)
        # A window starts at a word that has enough words of its own document after it.
        last = len(self.owner) - size + 1
        self.places = np.flatnonzero(self.owner[:last] == self.owner[size - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def hashes(self, lane: int) -> np.ndarray:
        if not len(self.places):
            return np.zeros(0, np.uint64)
        return window_hashes(span_hashes(self.data, self.starts, self.ends, lane), self.size)[self.places]

    def checks(self, chosen: np.ndarray) -> np.ndarray:
        """32 bits of an independent hash of the chosen windows."""
        if not len(chosen):
            return np.zeros(0, np.uint32)
        return (self.hashes(1)[chosen] >> np.uint64(32)).astype(np.uint32)


def _cell(hashes: np.ndarray, lane: int, bits: int) -> np.ndarray:
    return (mix(hashes ^ _SECOND) if lane else hashes) >> np.uint64(64 - bits)


def _sketch(size: int, bits: int, blocks: int):
    """Pass 1: the cells of a task's windows, by row and block."""
    inner = bits - blocks

    def flush(part: int, hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        together = np.concatenate(hashes)
        out: dict[str, list] = {name.split()[0]: [] for name in SKETCH.split(", ")}
        for lane in range(_ROWS):
            cells, counts = np.unique(_cell(together, lane, bits), return_counts=True)
            edges = np.searchsorted(cells, np.arange((1 << blocks) + 1, dtype=np.uint64) << np.uint64(inner))
            within, twice = cells & np.uint64((1 << inner) - 1), counts > 1
            for block in np.flatnonzero(np.diff(edges)).tolist():
                own = within[edges[block] : edges[block + 1]]
                out["lane"].append(lane)
                out["block"].append(block)
                out["part"].append(part)
                out["cells"].append(_deltas(own))
                out["twice"].append(_deltas(own[twice[edges[block] : edges[block + 1]]]))
        if out["lane"]:
            yield pa.RecordBatch.from_pydict(out, schema=_schema(SKETCH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count = None, [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for first, last, some, places in _runs(batch.column(1), data, offsets):
                if held and (batch.column(1)[first].as_py() != part or count >= _FLUSH):
                    yield from flush(part, held)
                    held, count = [], 0
                part = batch.column(1)[first].as_py()
                hashes = _Windows(some, places, size).hashes(0)
                held.append(hashes)
                count += len(hashes)
        if held:
            yield from flush(part, held)

    return run


def _runs(parts: pa.Array, data: np.ndarray, offsets: np.ndarray):
    """Slices of a batch that belong to one part each."""
    numbers = parts.to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        if low < high:
            begin = offsets[low]
            for first, last, some, places in slices(data[begin : offsets[high]], offsets[low : high + 1] - begin):
                yield low + first, low + last, some, places


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _merge_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """Add up one block of one row; each part's cells that hold two or more."""
    each = [_numbers(data) for data in rows["cells"]]
    twice = [_numbers(data) for data in rows["twice"]]
    cells, counts = np.unique(np.concatenate(each), return_counts=True)
    many = counts > 1
    many[np.searchsorted(cells, np.concatenate(twice))] = True
    kept = [own[many[np.searchsorted(cells, own)]] for own in each]
    result = rows[["part", "lane", "block"]].copy()
    result["cells"] = [_deltas(own) for own in kept]
    return result[[len(own) > 0 for own in kept]]


def _candidates(size: int, bits: int, blocks: int, folder: str):
    """Pass 2: the windows whose cells all hold two or more, with the smallest key that has them here."""

    def flush(part: int, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        hashes, checks, keys, keyed = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.lexsort((keys, ~keyed, checks, hashes))
        hashes, checks, keys, keyed = hashes[order], checks[order], keys[order], keyed[order]
        if not len(hashes):
            return
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(hashes)) - 1
        several = (keys[ends] != keys[at]) | (keyed[ends] != keyed[at])
        hashes, checks, keys, keyed = hashes[at], checks[at], keys[at], keyed[at]
        edges = np.searchsorted(hashes, np.arange(1 << blocks, dtype=np.uint64) << np.uint64(64 - blocks) if blocks else np.zeros(1, np.uint64))
        edges = np.append(edges, len(hashes))
        out: dict[str, list] = {name.split()[0]: [] for name in CANDIDATES.split(", ")}
        for block in np.flatnonzero(np.diff(edges)).tolist():
            own = slice(edges[block], edges[block + 1])
            out["block"].append(block)
            out["part"].append(part)
            out["hash"].append(hashes[own].tobytes())
            out["check"].append(checks[own].tobytes())
            out["key"].append(_coded(keys[own]))
            out["keyed"].append(np.packbits(keyed[own]).tobytes())
            out["several"].append(np.packbits(several[own]).tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=_schema(CANDIDATES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count, cells = None, [], 0, []
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            keys, keyed = _keys(batch.column(2))
            for first, last, some, places in _runs(batch.column(1), data, offsets):
                own = batch.column(1)[first].as_py()
                if held and (own != part or count >= _FLUSH):
                    yield from flush(part, held)
                    held, count = [], 0
                if own != part:
                    part, cells = own, _known_cells(folder, own, bits, blocks)
                windows = _Windows(some, places, size)
                hashes = windows.hashes(0)
                chosen = np.arange(len(hashes))
                for lane in range(_ROWS):
                    chosen = chosen[cells[lane].find(_cell(hashes[chosen], lane, bits))[0]]
                rows = first + windows.owner[windows.places[chosen]]
                held.append((hashes[chosen], windows.checks(chosen), keys[rows], keyed[rows]))
                count += len(chosen)
        if held:
            yield from flush(part, held)

    return run


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys as numbers, 0 for null, and which are not null."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _coded(keys: np.ndarray) -> bytes:
    """Keys of few documents: their number, the distinct keys, and for each its place among them."""
    distinct, codes = np.unique(keys, return_inverse=True)
    kind = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    return len(distinct).to_bytes(8, "little") + distinct.astype("<i8").tobytes() + codes.astype(kind).tobytes()


def _decoded(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    distinct = np.frombuffer(data, "<i8", count, 8)
    return distinct[np.frombuffer(data, np.uint16 if count <= 1 << 16 else np.uint32, offset=8 + 8 * count)]


def _known_cells(folder: str, part: int, bits: int, blocks: int) -> list[_Set]:
    table = read_part(folder, "part", part, ["lane", "block", "cells"])
    found: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in range(_ROWS)]
    if table is not None:
        for lane, block, cells in zip(*(table[name].to_pylist() for name in ("lane", "block", "cells")), strict=True):
            found[lane].append(_numbers(cells) + np.uint64(block << (bits - blocks)))
    return [_Set(np.unique(np.concatenate(one))) for one in found]


def _first_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """Group one block of candidates exactly; what each part has to know of its own."""
    hashes = [np.frombuffer(data, np.uint64) for data in rows["hash"]]
    sizes = [len(one) for one in hashes]
    checks = np.concatenate([np.frombuffer(data, np.uint32) for data in rows["check"]])
    keys = np.concatenate([_decoded(data) for data in rows["key"]])
    keyed, several = (
        np.concatenate(
            [np.unpackbits(np.frombuffer(data, np.uint8), count=size) for data, size in zip(rows[name], sizes, strict=True)]
        ).astype(bool)
        for name in ("keyed", "several")
    )
    together = np.concatenate(hashes)
    order = np.lexsort((keys, ~keyed, checks, together))
    new = np.ones(len(order), bool)
    new[1:] = (together[order][1:] != together[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    first = keys[leader]
    # Where rows without key are all that have a window, nobody loses it; so what is told comes from a key.
    told = several | (keyed[leader] & (~keyed | (first < keys)))
    out = {"part": [], "hash": [], "check": [], "key": []}
    at = 0
    for part, size, own in zip(rows["part"], sizes, hashes, strict=True):
        some = told[at : at + size]
        if some.any():
            out["part"].append(part)
            out["hash"].append(own[some].tobytes())
            out["check"].append(checks[at : at + size][some].tobytes())
            out["key"].append(_coded(first[at : at + size][some]))
        at += size
    return pd.DataFrame(out)


class _Firsts:
    """The smallest key of each window that a part has to know, found by hash and check."""

    def __init__(self, folder: str, part: int) -> None:
        table = read_part(folder, "part", part, ["hash", "check", "key"])
        columns = [table[name].to_pylist() if table is not None else [] for name in ("hash", "check", "key")]
        hashes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(data, np.uint64) for data in columns[0])])
        checks = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(data, np.uint32) for data in columns[1])])
        keys = np.concatenate([np.zeros(0, np.int64), *map(_decoded, columns[2])])
        order = np.lexsort((keys, checks, hashes))
        hashes, checks, keys = hashes[order], checks[order], keys[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
        hashes, self.checks, self.keys = hashes[new], checks[new], keys[new]
        values, self.begins, self.counts = np.unique(hashes, return_index=True, return_counts=True)
        self.known = _Set(values)

    def find(self, windows: _Windows) -> tuple[np.ndarray, np.ndarray]:
        """Which windows are known, and the smallest keys that have them."""
        found, at = self.known.find(windows.hashes(0))
        checks, key, sure = windows.checks(found), np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        # Windows of one hash and different checks follow each other; there is hardly ever more than one.
        for step in range(int(self.counts[at].max()) if len(at) else 0):
            place = self.begins[at] + np.minimum(step, self.counts[at] - 1)
            same = self.checks[place] == checks
            key[same], sure = self.keys[place[same]], sure | same
        return found[sure], key[sure]


def _removal(size: int, folder: str, with_text: bool, extra: list[str]):
    """Pass 3: the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, firsts = None, None
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            keys, keyed = _keys(batch.column(2))
            for first, last, some, places in _runs(batch.column(1), data, offsets):
                own = batch.column(1)[first].as_py()
                if own != part:
                    part, firsts = own, _Firsts(folder, own)
                windows = _Windows(some, places, size)
                found, smallest = firsts.find(windows)
                begins = windows.places[found]
                rows = first + windows.owner[begins]
                begins = begins[~keyed[rows] | (smallest < keys[rows])]
                edge = np.zeros(len(windows.owner) + 1, np.int64)
                np.add.at(edge, begins, 1)
                np.subtract.at(edge, begins + size, 1)
                kept = np.cumsum(edge[:-1]) == 0
                words = np.diff(windows.firsts)
                removed = np.bincount(windows.owner[~kept], minlength=last - first)
                columns = [
                    batch.column(2).slice(first, last - first),
                    pa.array(words),
                    pa.array(removed),
                    _joined(windows, kept, last - first),
                ]
                names = ["key", "n_words", "n_removed", "kept"]
                if with_text:
                    columns.append(batch.column(0).slice(first, last - first))
                    names.append("text")
                columns += [batch.column(3 + n).slice(first, last - first) for n in range(len(extra))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *extra])

    return run


def _joined(windows: _Windows, kept: np.ndarray, count: int) -> pa.Array:
    """The words that stay, with one blank between them."""
    starts, ends, owner = windows.starts[kept], windows.ends[kept], windows.owner[kept]
    lengths = ends - starts
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    wide = lengths + ~last
    shift = np.cumsum(wide) - wide
    source = np.repeat(starts - shift, wide) + np.arange(int(wide.sum()))
    blanks = (shift + lengths)[~last]
    out = windows.data[np.minimum(source, len(windows.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[blanks] = 32
    sizes = np.zeros(count, np.int64)
    np.add.at(sizes, owner, wide)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(count, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def remove_repeated(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """Remove every word in a window of ``size`` words that also starts in a document with a smaller key.

    Windows are judged on the input. Words are runs of bytes that are no ASCII white space, unchanged. One
    row for each row of ``df``: ``key``, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by
    one blank), and with ``keep`` the whole ``text`` and ``extra``, a struct of the columns named there.

    Nulls: a null text has no words; a row without key comes after all others, so it loses what any keyed
    document has and takes nothing from them, whatever number the last key is. Rows of one key, repeated rows
    among them, do not take from each other. Texts shorter than a window stay whole; long ones are searched
    whole. Keys are whole numbers of 64 bits. An empty table gives an empty one. Column names cannot clash:
    other columns are carried inside ``extra``.
    """
    spark = df.sparkSession
    extra = [F.struct(*[F.col(f"`{name}`") for name in keep]).alias("extra")] if keep else []
    rows = df.select(
        F.col(text).alias("text"), F.spark_partition_id().cast("long").alias("part"), F.col(key).cast("long").alias("key"), *extra
    )
    texts, _ = stages.written(rows, "window-texts")
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Two cells for each byte are about a dozen for each word.
    bits = max(16, int(2 * volume).bit_length())
    blocks = min(max(0, int(volume // 7 // _PER_BLOCK).bit_length()), bits - 8)
    sketch = texts.select("text", "part").mapInArrow(_sketch(size, bits, blocks), SKETCH)
    cells = sketch.groupBy("lane", "block").applyInPandas(_merge_cells, CELLS)
    _, cell_folder = stages.written(cells.repartition("part"), "window-cells", "part")
    found = texts.select("text", "part", "key").mapInArrow(_candidates(size, bits, blocks, cell_folder), CANDIDATES)
    firsts = found.groupBy("block").applyInPandas(_first_documents, FIRSTS)
    _, first_folder = stages.written(firsts.repartition("part"), "window-firsts", "part")
    stages.dropped(cell_folder)
    names = ["extra"] if keep else []
    ddl = "key long, n_words long, n_removed long, kept string"
    if keep:
        ddl += f", text string, extra {texts.schema['extra'].dataType.simpleString()}"
    rest = _removal(size, first_folder, bool(keep), names)
    return texts.select("text", "part", "key", *names).mapInArrow(rest, ddl)



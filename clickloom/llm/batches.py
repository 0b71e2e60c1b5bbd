"""Texts of an Arrow batch as bytes, and hashes of many byte spans at once.

All of it works on slices of a megabyte, so memory stays bounded whatever the batch holds; only a
single text longer than that makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_WINDOW = 1 << 18
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

# White space as in C's isspace: the blank and the bytes 9 to 13.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
# ASCII letters and digits, and every byte of a character beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[128:] = True
for _low, _high in (b"09", b"az", b"AZ"):
    WORD_BYTE[_low : _high + 1] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its values; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column) or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    everything = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return everything[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole values of at most ``size`` bytes (or one longer value): first, last, bytes, offsets."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, count)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes inside each value: starts, ends, and the number of the first run of each value."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    before[inner] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    after[inner - 1] = False
    return starts, np.flatnonzero(mask & ~after) + 1, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power_table(lane: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    table = _powers.get(lane)
    if table is None or len(table[0]) < size:
        size = max(size, _WINDOW * 2)
        base = _MULTIPLIERS[lane]
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            powers = np.full(size, factor, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        table = both[0], both[1]
        if size <= _WINDOW * 16:
            _powers[lane] = table
    return table


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans ascend. Two lanes are independent."""
    result = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(starts, base + _WINDOW)))
        top = int(ends[last - 1])
        powers, inverse = _power_table(lane, top - base + 1)
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * powers[: top - base], out=sums[1:])
        low, high = starts[first:last] - base, ends[first:last] - base
        result[first:last] = (sums[high] - sums[low]) * inverse[low] + (high - low).astype(np.uint64)
        first = last
    return mix(result)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` values in a row, one for each start; windows across values are the caller's to drop."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    factor = 0x2545F4914F6CDD1D
    for place in range(size):
        total += hashes[place : place + count] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64) | 1
    return mix(total)


def owners(firsts: np.ndarray) -> np.ndarray:
    """The number of the value that each run belongs to, from the first run of each value."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))

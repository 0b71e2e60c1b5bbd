"""CRC-32C of many byte strings at once, by table and by matrices over GF(2)."""

from __future__ import annotations

import functools

import numpy as np

_REVERSED_POLYNOMIAL = 0x82F63B78  # Fixed value: Castagnoli, bits reversed.
_MASK_DELTA = 0xA282EAD8  # Fixed value of the framing's mask.
_BLOCK = 256


@functools.cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_REVERSED_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _zero_byte(states: np.ndarray) -> np.ndarray:
    return _byte_table()[states & 0xFF] ^ (states >> np.uint32(8))


@functools.cache
def _zeros(log2: int) -> np.ndarray:
    """Four tables that move a state over ``2 ** log2`` zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    states = np.stack([values << np.uint32(8 * place) for place in range(4)])
    if log2 == 0:
        return _zero_byte(states)
    return _apply(_zeros(log2 - 1), _apply(_zeros(log2 - 1), states))


def _apply(tables: np.ndarray, states: np.ndarray) -> np.ndarray:
    result = tables[0][states & 0xFF]
    for place in range(1, 4):
        result = result ^ tables[place][(states >> np.uint32(8 * place)) & 0xFF]
    return result


def crc32c(values: list[bytes]) -> np.ndarray:
    """The CRC-32C of each value. Blocks of all values advance together; then each value's blocks are joined."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    if not len(lengths):
        return np.zeros(0, np.uint32)
    blocks = -(-lengths // _BLOCK)
    # Zero bytes in front do not change a state that starts with zero.
    padded = b"".join(bytes(pad) + value for pad, value in zip((blocks * _BLOCK - lengths).tolist(), values, strict=True))
    columns = np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(-1, _BLOCK).T)
    states = np.zeros(columns.shape[1], np.uint32)
    table = _byte_table()
    for column in columns:
        states = table[(states ^ column) & np.uint32(0xFF)] ^ (states >> np.uint32(8))
    first = np.cumsum(blocks) - blocks
    order = np.argsort(-blocks, kind="stable")
    result = np.zeros(len(lengths), np.uint32)
    step = _zeros(_BLOCK.bit_length() - 1)
    active = order
    for number in range(int(blocks.max())):
        active = active[: int(np.searchsorted(-blocks[active], -number, "left"))]
        result[active] = _apply(step, result[active]) ^ states[first[active] + number]
    start = np.full(len(lengths), 0xFFFFFFFF, np.uint32)
    for bit in range(int(lengths.max()).bit_length()):
        chosen = (lengths >> bit & 1).astype(bool)
        start[chosen] = _apply(_zeros(bit), start[chosen])
    return result ^ start ^ np.uint32(0xFFFFFFFF)


def masked(checksums: np.ndarray) -> np.ndarray:
    """Checksums of data that itself holds checksums are stored rotated and shifted by a constant."""
    return ((checksums >> np.uint32(15)) | (checksums << np.uint32(17))) + np.uint32(_MASK_DELTA)

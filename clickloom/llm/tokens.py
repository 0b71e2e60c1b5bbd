"""Token ids of whole texts by the ``tokenizers`` library, each distinct unit of a task encoded once.

Byte-level BPE first cuts a text into pre-tokens and never merges across them. A blank before a character
that is no white space always starts a pre-token, and a single line feed between two such characters is one
of its own. The text is cut at those places only; the units are looked up by hash, new ones are encoded.

The literals of added tokens, special ones among them, get their own ids, as the library does it by default.
They cut a text before the pre-tokens do, so white space before one belongs to what it ends: no unit starts
next to a literal or inside one.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
from tokenizers import Tokenizer

from clickloom.llm.batches import owners, slices, span_hashes

LINE_FEED = 10
BLANK = 32
MOST_KNOWN = 1 << 21
SLICE = 2 << 20
_LINES = 200
_SPACE = re.compile(r"\s")

# First bytes of characters that are surely no white space. Those of C2, E1, E2 and E3 may be; no cut there.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_PLAIN[0xC3:0xE1] = True
_PLAIN[0xE4:0xF5] = True
# Last bytes before a line feed that are surely no white space.
_PLAIN_END = np.zeros(256, bool)
_PLAIN_END[0x21:0x7F] = True


class Encoder:
    """Encodes the texts of one task; keeps at most ``MOST_KNOWN`` units and starts afresh beyond them."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        added = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()} - {""}
        self.literals: dict[bytes, tuple[bytes, ...]] = {}
        for literal in sorted(map(str.encode, added), key=len, reverse=True):
            self.literals[literal[:2]] = (*self.literals.get(literal[:2], ()), literal)
        self.literal = re.compile("|".join(map(re.escape, sorted(added))) or "(?!)")
        self.spaced = any(_SPACE.search(literal) for literal in added)
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new units. Those without white space or literals inside go by the hundred as texts of one line each."""
        raw = data.tobytes()
        units = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        joined = len(self.line_feed) == 1 and not self.spaced
        plain = [joined and _SPACE.search(unit, unit[0] == " ") is None and self.literal.search(unit) is None for unit in units]
        plain = np.array(plain, bool)
        found, lengths = [], np.zeros(len(units), np.int64)
        if plain.any():
            lines = [unit + "\n" for unit, one in zip(units, plain, strict=True) if one]
            parts = []
            for n in range(0, len(lines), _LINES):
                # One text after the other: what the library holds for a text is far larger than its ids.
                one = self.tokenizer.encode_batch_fast(["".join(lines[n : n + _LINES])], add_special_tokens=False)
                parts.append(np.array(one[0].ids, np.uint32))
            ids = np.concatenate(parts)
            feeds = np.flatnonzero(ids == self.line_feed[0])
            lengths[plain] = np.diff(feeds, prepend=-1) - 1
            found.append(np.delete(ids, feeds))
        rest = np.flatnonzero(~plain)
        if len(rest):
            encoded = self.tokenizer.encode_batch_fast([units[n] for n in rest], add_special_tokens=False)
            found += [np.array(one.ids, np.uint32) for one in encoded]
            lengths[rest] = [len(one.ids) for one in encoded]
        order = np.concatenate([np.flatnonzero(plain), rest])
        places = len(self.ids) + np.cumsum(lengths[order]) - lengths[order]
        self.ids = np.concatenate([self.ids, *found])
        sort = np.argsort(keys[order])
        order, places = order[sort], places[sort]
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.places = np.insert(self.places, at, places)
        self.lengths = np.insert(self.lengths, at, lengths[order])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text start."""
        counts = np.zeros(len(offsets) - 1, np.int64)
        found = []
        for first, last, part, places in slices(data, offsets, SLICE):
            ids, lengths = self._encode_slice(part, places)
            counts[first:last] = lengths
            found.append(ids)
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def _literals(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where literals start and end; of those with one start the longest, whether they overlap or not."""
        raw, low, high = data.tobytes(), [], []
        for head, literals in self.literals.items():
            at = raw.find(head)
            while at >= 0:
                longest = next((literal for literal in literals if raw.startswith(literal, at)), None)
                if longest is not None:
                    low.append(at)
                    high.append(at + len(longest))
                at = raw.find(head, at + 1)
        return np.array(low, np.int64), np.array(high, np.int64)

    def _encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        starts, firsts = unit_starts(data, offsets)
        low, high = self._literals(data)
        if len(low):
            starts, firsts = _apart(starts, offsets, low, high)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        keys, where, number = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > MOST_KNOWN:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            order = np.sort(where[new])
            self._learn(data, hashes[order], starts[order], ends[order])
            at = np.searchsorted(self.keys, keys)
        places, lengths = self.places[at][number].astype(np.int64), self.lengths[at][number].astype(np.int64)
        total = int(lengths.sum())
        shift = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(places - shift, lengths) + np.arange(total)]
        return ids, np.bincount(owners(firsts), lengths, len(offsets) - 1).astype(np.int64)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units start, and the number of the first unit of each text."""
    plain = _PLAIN[data]
    ahead = np.zeros(len(data), bool)
    ahead[:-1] = plain[1:]
    start = (data == BLANK) & ahead
    behind = np.zeros(len(data), bool)
    behind[1:] = _PLAIN_END[data[:-1]]
    feed = (data == LINE_FEED) & ahead & behind
    start |= feed
    start[1:] |= feed[:-1]
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    # A blank or line feed that ends a text has the next text's first character behind it.
    for name in (BLANK, LINE_FEED):
        last = offsets[1:][np.diff(offsets) > 1] - 1
        last = last[(data[last] == name)]
        start[last] = False
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, offsets)


def _apart(starts: np.ndarray, offsets: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts that are safe with literals from ``low`` to ``high``, and the first unit of each text.

    Those from the byte before a literal to the one behind it go, and the next one, which may end white space
    that the literal takes with it. Larger units are always right; texts still start units.
    """
    first = np.searchsorted(starts, low - 1)
    last = np.minimum(np.searchsorted(starts, high + 1, "right") + 1, len(starts))
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    kept = np.cumsum(change)[:-1] == 0
    kept |= np.isin(starts, offsets[:-1])
    starts = starts[kept]
    return starts, np.searchsorted(starts, offsets)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker; what it knows serves later tasks too.

    Spark runs as many tasks as there are cores, so the library must not start threads of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


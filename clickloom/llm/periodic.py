"""Stretches of words that repeat with a period, found by recompression.

A run of period q and at least three periods holds, for any grid of step d up to its equal stretch, a grid point i
with word i = word i + q for some words on; such (i, q) are the candidates. How far words q apart stay equal, in both
directions, is answered by a grammar of the text:

* levels of the grammar replace blocks of one letter by a letter for (letter, length), then pairs of letters by
  a new one, where a random half of the letters may come first and the other half second. Equal stretches
  are therefore replaced alike but for their edges, which gives few steps a level;
* a comparison of two places climbs while both begin a node, takes what is equal at the edge of one, and at the
  first difference descends to the words.

All texts of a slice are in one grammar, with marks of their own between them that equal nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import NOT_SPACE, owners, slices, span_hashes, spans, text_bytes, window_hashes

LEAST_LENGTH, LEAST_PERIODS = 24, 3
# Words from a grid point on that must agree before the grammar is asked.
_PROBE = 8
_QUERIES = 1 << 17
# Batches of candidates that are held at a time.
_HELD = 8
RUN = "struct<start: long, length: long, period: long>"
FOUND = f"key long, n_runs long, runs array<{RUN}>, strongest {RUN}, collapsed string"


@dataclass
class Grammar:
    """All levels one after the other; a node is its place in these arrays.

    ``letter`` tells equal nodes of one level, ``parent`` the node above (-1 at the top), ``child`` the first
    node below (-1 for a word), ``width`` how many words it spans. ``leads`` is whether it is the first
    below its parent, ``rest`` how many equal letters of a block follow, itself included.
    """

    letter: np.ndarray
    parent: np.ndarray
    child: np.ndarray
    width: np.ndarray
    leads: np.ndarray
    rest: np.ndarray


def _new_letters(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each distinct pair."""
    _, code = np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)
    return code.astype(np.int64)


def grammar(letters: np.ndarray, seed: int = 3) -> tuple[Grammar, Grammar]:
    """The grammar of a sequence of small whole numbers, read forwards and backwards."""
    source = np.random.default_rng(seed)
    levels: list[tuple[np.ndarray, np.ndarray]] = []  # letters, and for each its node above
    widths, idle = [np.ones(len(letters), np.int64)], 0
    blocks = True
    while len(letters) > 1 and idle < 64:
        if blocks:
            begins = np.concatenate([[True], letters[1:] != letters[:-1]])
        else:
            first = source.integers(0, 2, int(letters.max()) + 1).astype(bool)[letters]
            begins = np.ones(len(letters), bool)
            begins[1:] = ~(first[:-1] & ~first[1:])
        at = np.flatnonzero(begins)
        sizes = np.diff(np.append(at, len(letters)))
        idle = idle + 1 if len(at) == len(letters) else 0
        levels.append((letters, np.cumsum(begins) - 1))
        if blocks:
            letters = _new_letters(letters[at], sizes)
        else:
            letters = _new_letters(letters[at], np.where(sizes == 2, letters[np.minimum(at + 1, len(letters) - 1)] + 1, 0))
        widths.append(np.add.reduceat(widths[-1], at))
        blocks = not blocks
    levels.append((letters, np.full(len(letters), -1)))
    return _flat(levels, widths, False), _flat(levels, widths, True)


def _flat(levels: list[tuple[np.ndarray, np.ndarray]], widths: list[np.ndarray], backwards: bool) -> Grammar:
    out: dict[str, list[np.ndarray]] = {name: [] for name in Grammar.__dataclass_fields__}
    offset = below = 0
    child = np.full(len(levels[0][0]), -1)
    for n, ((letters, parent), width) in enumerate(zip(levels, widths, strict=True)):
        count, top = len(letters), n == len(levels) - 1
        if backwards:
            letters, width = letters[::-1], width[::-1]
            parent = parent[::-1] if top else len(levels[n + 1][0]) - 1 - parent[::-1]
        leads = np.ones(count, bool)
        leads[1:] = parent[1:] != parent[:-1]
        rest = np.ones(count, np.int64)
        if not top:
            at = np.flatnonzero(leads)
            sizes = np.diff(np.append(at, count))
            if n % 2 == 0:
                rest = np.repeat(at + sizes, sizes) - np.arange(count)
        out["letter"].append(letters)
        out["width"].append(width)
        out["child"].append(child if not n else child + below)
        out["leads"].append(leads & (not top))
        out["rest"].append(rest)
        out["parent"].append(np.full(count, -1) if top else parent + offset + count)
        if not top:
            child, below = at, offset
        offset += count
    return Grammar(**{name: np.concatenate(parts) for name, parts in out.items()})


def common_extension(of: Grammar, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from places i and j on are equal. Something must differ before the end."""
    u, v, length = i.astype(np.int64), j.astype(np.int64), np.zeros(len(i), np.int64)
    active, down = np.arange(len(i)), np.zeros(len(i), bool)
    while len(active):
        a, b, falling = u[active], v[active], down[active]
        equal = of.letter[a] == of.letter[b]
        up = equal & ~falling & of.leads[a] & of.leads[b]
        take = equal & ~up
        step = np.minimum(of.rest[a], of.rest[b])
        length[active[take]] += (step * of.width[a])[take]
        falling = falling | ~equal
        u[active] = np.where(up, of.parent[a], np.where(take, a + step, of.child[a]))
        v[active] = np.where(up, of.parent[b], np.where(take, b + step, of.child[b]))
        down[active] = falling
        active = active[equal | (of.child[a] >= 0)]
    return length


def _candidates(probes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods q, in ascending order of q: grid points where the next words equal those q later."""
    sizes = np.diff(firsts)
    by_size = np.argsort(-sizes, kind="stable")
    held_i, held_q, count = [], [], 0
    q = 0
    while True:
        q += 1
        stretch = max((LEAST_PERIODS - 1) * q, LEAST_LENGTH - q)
        documents = by_size[: int(np.searchsorted(-sizes[by_size], -max(LEAST_LENGTH, LEAST_PERIODS * q), "right"))]
        if not len(documents):
            break
        step = max(1, stretch // 2)
        # All grid points of all texts that are long enough; the window after i + q must lie in the text.
        points = np.maximum(0, (sizes[documents] - q - _PROBE) // step + 1)
        within = np.arange(int(points.sum())) - np.repeat(np.cumsum(points) - points, points)
        i = np.repeat(firsts[documents], points) + within * step
        i = i[probes[i] == probes[i + q]]
        if len(i):
            held_i.append(i)
            held_q.append(np.full(len(i), q))
            count += len(i)
        if count >= _QUERIES:
            yield np.concatenate(held_i), np.concatenate(held_q)
            held_i, held_q, count = [], [], 0
    if held_i:
        yield np.concatenate(held_i), np.concatenate(held_q)


def find_runs(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of texts whose words have these hashes; text n begins at firsts[n]."""
    none = np.zeros(0, np.int64)
    probes = window_hashes(hashes, _PROBE)
    batches = _candidates(probes, firsts) if len(probes) else iter(())
    begun = list(islice(batches, _HELD))
    if not begun:
        return none, none, none
    owner = owners(firsts)
    # Only texts with a candidate need a grammar. Where there are too many candidates to hold, all texts get one.
    texts = np.unique(np.concatenate([owner[i] for i, _ in begun])) if len(begun) < _HELD else np.flatnonzero(np.diff(firsts))
    sizes = np.diff(firsts)[texts]
    places = np.concatenate([[1], np.cumsum(sizes + 1) + 1])[:-1]
    _, codes = np.unique(np.concatenate([hashes[firsts[t] : firsts[t + 1]] for t in texts.tolist()]), return_inverse=True)
    letters = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    letters[np.repeat(places - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))] = codes
    letters[np.concatenate([[0], places + sizes])] = len(hashes) + np.arange(len(texts) + 1)
    _, letters = np.unique(letters, return_inverse=True)
    forwards, backwards = grammar(letters)
    shift = np.zeros(len(firsts) - 1, np.int64)
    shift[texts] = places - firsts[texts]
    known_end, known_period = np.zeros(len(hashes), np.int64), np.ones(len(hashes), np.int64)
    found = []
    for i, q in chain(begun, batches):
        for part in range(0, len(i), _QUERIES):
            a, p = i[part : part + _QUERIES], q[part : part + _QUERIES]
            # Inside a known run, multiples of its period say nothing new.
            new = (p % known_period[a] != 0) | (a + p >= known_end[a])
            a, p = a[new], p[new]
            if not len(a):
                continue
            at = a + shift[owner[a]]
            right = common_extension(forwards, at, at + p)
            left = common_extension(backwards, len(letters) - at, len(letters) - at - p)
            start, end = a - left, a + p + right
            long = end - start >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * p)
            start, end, p = start[long], end[long], p[long]
            order = np.lexsort((p, end, start))
            start, end, p = start[order], end[order], p[order]
            one = np.ones(len(start), bool)
            one[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
            start, end, p = start[one], end[one], p[one]
            for s, e, period in zip(start.tolist(), end.tolist(), p.tolist(), strict=True):
                known_end[s:e], known_period[s:e] = e, period
            found.append((start, end, p))
    start, end, p = (np.concatenate(column) for column in zip(*found, strict=True)) if found else (none, none, none)
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    order = np.lexsort((p[one], start[one]))
    return start[one][order], end[one][order], p[one][order]


def _planted(h: np.ndarray, known: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each word the word that stands there: texts whose number h is divisible by 10 get a periodic end."""
    source = np.arange(int(firsts[-1]))
    for n in np.flatnonzero(known & (h % 10 == 0) & (np.diff(firsts) > 0)).tolist():
        begin, size, g = int(firsts[n]), int(firsts[n + 1] - firsts[n]), int(h[n]) // 10
        a = g % size
        p = 1 + (size - a) // (3 + g % 8)
        source[begin + a : begin + size] = begin + a + np.arange(size - a) % p
    return source


def _search(with_plants: bool):
    names = ["key", "n_runs", "runs", "strongest", "collapsed"]
    fields = [pa.field(name, pa.int64()) for name in ("start", "length", "period")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last, some, ends in slices(data, offsets):
                starts, stops, firsts = spans(NOT_SPACE[some], ends)
                hashes = span_hashes(some, starts, stops)
                if with_plants:
                    plants = batch.column(2).slice(first, last - first)
                    source = _planted(plants.fill_null(1).to_numpy(zero_copy_only=False), ~np.asarray(plants.is_null()), firsts)
                    hashes, starts, stops = hashes[source], starts[source], stops[source]
                start, end, period = find_runs(hashes, firsts)
                owner, texts = owners(firsts), last - first
                of = owner[start] if len(start) else np.zeros(0, np.int64)
                count = np.bincount(of, minlength=texts)
                edge = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.subtract.at(edge, end, 1)
                kept = np.cumsum(edge[:-1]) == 0
                runs = [start - firsts[of], end - start, period]
                places = np.concatenate([[0], np.cumsum(count)])
                lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.StructArray.from_arrays([pa.array(c) for c in runs], fields=fields))
                # A quotient of two such numbers is rounded alike for equal fractions and apart for others.
                ranked = np.lexsort((period, start, -(runs[1] / period), of)) if len(of) else of
                best = np.full(texts, -1)
                at = ranked[np.flatnonzero(np.concatenate([[True], of[ranked][1:] != of[ranked][:-1]]))] if len(of) else of
                best[of[at]] = at
                chosen = [pa.array(np.append(column, 0)[best]) for column in runs]
                strongest = pa.StructArray.from_arrays(chosen, fields=fields, mask=pa.array(best < 0))
                columns = [batch.column(0).slice(first, texts), pa.array(count.astype(np.int64)), lists, strongest]
                yield pa.RecordBatch.from_arrays([*columns, _words(some, starts[kept], stops[kept], owner[kept], texts)], names=names)

    return run


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, count: int) -> pa.Array:
    """The words of each text, joined by one blank."""
    lengths = ends - starts
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    wide = lengths + ~last
    shift = np.cumsum(wide) - wide
    source = np.repeat(starts - shift, wide) + np.arange(int(wide.sum()))
    out = data[np.minimum(source, len(data) - 1)] if len(source) else np.zeros(0, np.uint8)
    out[(shift + lengths)[~last]] = 32
    sizes = np.zeros(count, np.int64)
    np.add.at(sizes, owner, wide)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(count, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """The runs of each text: key, ``n_runs``, ``runs``, ``strongest`` and ``collapsed``.

    A run is a stretch of words that repeats with a smallest period, is at least 24 words and three periods
    long, and is not extended by a neighbouring word. ``runs`` has start (a word number), length and period, by start, then
    period; ``strongest`` is the one with the greatest length over period (ties: smallest start, then
    period). ``collapsed`` are the words, joined by one blank, without those that lie in a run after its first
    period. Words are runs of bytes that are no ASCII white space, unchanged.

    With ``planted``, texts whose crc32 of the decimal key is divisible by 10 first get a periodic end: word
    i >= a becomes word ``a + (i - a) % p``, with ``g = crc32 // 10``, ``a = g % n`` and
    ``p = 1 + (n - a) // (3 + g % 8)`` for n words. Keys are whole numbers; any other type is refused.

    Nulls and empty texts have no words and no run; a row without key is searched like any other, but nothing
    is planted. Texts are read whole, however long, each in one task. Repeated rows each get their row. An
    empty table gives an empty one. Other columns are not read, so their names may clash. Words are told apart by 64 hash bits.
    """
    stages.whole_keys(df, key)
    number = F.crc32(F.col(key).cast("string").cast("binary")).alias("number")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), number)
    return rows.mapInArrow(_search(planted), FOUND)

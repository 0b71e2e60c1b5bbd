"""Periodic runs by recompression, against all periods one by one."""

from __future__ import annotations

import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import periodic


def brute(words):
    """Start, length and smallest period of all runs."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > begin and i + q - begin >= max(24, 3 * q):
                found.setdefault((begin, i + q - begin), q)
            i += 1
    return sorted((start, length, q) for (start, length), q in found.items())


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(key, text, with_plants):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = planted(key, words) if with_plants else words
    runs = sorted(brute(words), key=lambda run: (run[0], run[2]))
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)
    return key, len(runs), runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed=7):
    source, rows = random.Random(seed), []
    for key in range(160):
        words = source.choices(["a", "b", "é", "d"][: source.randint(1, 4)] + [f"w{n}" for n in range(source.choice([0, 3, 200]))], k=source.choice([0, 1, 23, 24, 60, 300]))
        if words and source.random() < 0.5:
            unit = words[: source.randint(1, 12)]
            at = source.randrange(len(words))
            words[at:at] = unit * source.randint(2, 30)
        rows.append((key, source.choice([" ", "  ", "\n"]).join(words)))
    return [*rows, (7, rows[3][1]), (None, "x " * 40), (None, None), (500, ""), (501, None), (502, " \t"), (2**62, "y\x0b" * 24)]


@pytest.mark.parametrize("with_plants", [False, True])
def test_runs_of_texts(spark, with_plants):
    rows = texts()
    df = spark.createDataFrame([(*row, 1, "r") for row in rows], "doc_id long, text string, runs int, key string").repartition(3)
    found = periodic.periodic_runs(df, planted=with_plants).collect()
    got = [(r.key, r.n_runs, [tuple(x) for x in r.runs], tuple(r.strongest) if r.strongest else None, r.collapsed) for r in found]
    assert sorted(got, key=str) == sorted((expected(*row, with_plants) for row in rows), key=str)


def extension(letters, i, j):
    n = 0
    while letters[i + n] == letters[j + n]:
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=120), st.integers(1, 5), st.integers(0, 9))
def test_extensions_by_grammar(words, times, seed):
    """Any two places, forwards and backwards."""
    words = words * times
    letters = np.array([9, *words, 8])
    forwards, backwards = periodic.grammar(letters, seed)
    source = np.random.default_rng(seed)
    i = source.integers(1, len(words) + 1, 50)
    j = source.integers(1, len(words) + 1, 50)
    i, j = i[i != j], j[i != j]
    assert periodic.common_extension(forwards, i, j).tolist() == [extension(letters, a, b) for a, b in zip(i, j, strict=True)]
    turned = letters[::-1]
    last = len(letters) - 1
    assert periodic.common_extension(backwards, last - i, last - j).tolist() == [extension(turned, last - a, last - b) for a, b in zip(i, j, strict=True)]


def test_grammar_is_small():
    """Levels grow with the logarithm of the length, also for blocks and periods."""
    for words in (np.zeros(100_000, np.int64), np.arange(100_000) % 7, np.random.default_rng(1).integers(0, 50, 100_000)):
        forwards, _ = periodic.grammar(np.concatenate([[98], words, [99]]))
        assert len(forwards.letter) < 12 * len(words)
        assert int((forwards.parent < 0).sum()) == 1


def test_one_long_text():
    """A period over a very long text, and more candidates than are held at a time."""
    words = np.tile(np.arange(5, dtype=np.uint64), 20_000)
    held, periodic._HELD = periodic._HELD, 1
    try:
        start, end, period = periodic.find_runs(words, np.array([0, len(words)]))
    finally:
        periodic._HELD = held
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [len(words)], [5])


def test_no_rows_and_other_keys(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(TypeError):
        periodic.periodic_runs(spark.createDataFrame([("1", "a")], "doc_id string, text string"))

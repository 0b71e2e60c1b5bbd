"""Near copies by banded candidates and sequential verification, against brute force."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import numpy as np
import pytest

from clickloom.llm import stages, verified_copies
from clickloom.llm.verified_copies import Settings, near_copies

WORDS = [f"w{n}" for n in range(400)]
SCHEMA = "doc_id long, text string, a string, class string, component int"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def expected(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if shared and 100 * shared >= 80 * (len(x) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    low = {}
    for n, (key, _) in enumerate(rows):
        if key is not None:
            low[root(n)] = min(key, low.get(root(n), key))
    found = [(key, len(x), low.get(root(n))) for n, ((key, _), x) in enumerate(zip(rows, sets, strict=True))]
    return sorted([(*row, row[0] == row[2]) for row in found], key=str)


def changed(source, words, count):
    words = list(words)
    for _ in range(count):
        words[source.randrange(len(words))] = source.choice(WORDS)
    return " ".join(words)


def corpus(seed=3):
    source = random.Random(seed)
    rows = [(n, " ".join(source.choices(WORDS, k=source.choice([1, 3, 4, 30, 200])))) for n in range(40)]
    for base in range(6):
        words = source.choices(WORDS, k=source.choice([80, 150, 400]))
        rows += [(100 + 40 * base + n, changed(source, words, source.choice([0, 1, 2, 5]))) for n in range(25)]
    # Most share half their words, so they meet in buckets without being similar.
    line = source.choices(WORDS, k=60)
    rows += [(500 + n, " ".join(line + source.choices(WORDS, k=25))) for n in range(80)]
    # A chain: neighbours are similar, ends are not.
    words = source.choices(WORDS, k=100)
    for n in range(12):
        rows.append((700 + n, " ".join(words)))
        words = words[3:] + source.choices(WORDS, k=3)
    text = rows[45][1]
    rows += [(900, text.upper()), (900, text), (900, text), (None, text), (None, "ÄÖ ä\x0bö x y"), (901, "äö ä ö"), (902, ""), (903, None), (904, " \t\n")]
    return [*rows, (-7, rows[0][1]), (905, "one two three"), (906, "ONE\ttwo\nthree"), (None, None), (2**63 - 1, rows[1][1])]


def found(df, **changes):
    result = near_copies(df, settings=replace(Settings(), **changes))
    assert result.columns == ["key", "n_shingles", "component", "kept"]
    return sorted([tuple(row) for row in result.collect()], key=str)


@pytest.mark.parametrize("changes", [{}, {"cell": 8}])
def test_near_copies(spark, changes, monkeypatch):
    """With cells of 8 classes, buckets are cut into blocks."""
    if changes:
        monkeypatch.setattr(verified_copies, "HOT_BUCKETS", 100)
    rows = corpus()
    df = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], SCHEMA).repartition(5)
    want = [(key, n, low, (key == low) if key is not None else low is None) for key, n, low, _ in expected(rows)]
    assert found(df, **changes) == sorted(want, key=str)


def test_single_links_are_found(spark):
    """Pairs just at the threshold, each the only link of its group: the hardest case for bands and pruning."""
    source, rows = random.Random(8), []
    for n in range(150):
        words = [f"{n}x{k}" for k in range(103)]
        # 100 shingles each; the other text shares 89 or 90 of them: 100 * 89 / 111 = 80.18
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(words[: 103 - 11] + [f"{n}y{k}" for k in range(11)]))]
    source.shuffle(rows)
    result = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [row[2] for row in result] == [row[2] for row in expected(rows)]
    assert sum(not row[3] for row in result) == 150


def test_a_group_of_copies_takes_few_comparisons(spark, monkeypatch):
    """A third of all rows in one group: pairs grow with the group, not with its square."""
    source = random.Random(2)
    words = source.choices(WORDS, k=120)
    rows = [(n, changed(source, words, 2)) for n in range(400)] + [(1000 + n, " ".join(source.choices(WORDS, k=60))) for n in range(800)]
    sizes = []
    real = stages.written

    def counted(df, purpose, *rest, **more):
        table, folder = real(df, purpose, *rest, **more)
        if purpose in ("copy-survivors", "copy-pairs", "copy-partners", "copy-ties"):
            sizes.append(table.count())
        return table, folder

    monkeypatch.setattr(stages, "written", counted)
    result = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(row[2] == 0 for row in result) == 400
    assert max(sizes) < 32 * 400


def test_tables_without_rows_or_links(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == []
    assert found(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert found(spark.createDataFrame([(1, "a b"), (2, "a c")], "doc_id int, text string")) == [(1, 1, 1, True), (2, 1, 2, True)]
    with pytest.raises(TypeError):
        near_copies(spark.createDataFrame([("1", "a")], "doc_id string, text string"))


def test_sequential_pruning():
    """The share of similar pairs that a test prunes stays below what was chosen, and most others go early."""
    settings = replace(Settings(), miss=1e-3)
    source, steps = np.random.default_rng(5), settings.least_equal()
    left = source.integers(0, 256, (20_000, settings.length), dtype=np.uint8)
    for similarity, most, least in ((0.8, 1.0, 0.99), (0.5, 0.02, 0.0)):
        right = np.where(source.random(left.shape) < similarity, left, source.integers(0, 256, left.shape, dtype=np.uint8))
        rows = np.arange(len(left))
        share = len(verified_copies._sequential(left, right, rows, rows, steps)[0]) / len(left)
        assert least <= share <= most


def test_shared_elements_of_many_sets(monkeypatch):
    monkeypatch.setattr(verified_copies, "_COLUMNS", 7)
    source = random.Random(4)
    sets = [set(source.sample(range(40), source.randint(0, 30))) for _ in range(20)]
    edges = np.concatenate([[0], np.cumsum([len(one) for one in sets])])
    values = np.array([value for one in sets for value in sorted(one)], np.int64)
    assert verified_copies._shared(values, edges).tolist() == [[len(x & y) for y in sets] for x in sets]


def test_large_buckets_of_the_same_classes_are_compared_once(spark, monkeypatch):
    """Half of a large group are no copies of the rest, and all share many buckets."""
    source = random.Random(6)
    words = source.choices(WORDS, k=120)
    rows = [(n, changed(source, words, 1 + n % 2 * 7)) for n in range(300)]
    counts, real = [], verified_copies._Search.cells

    def counted(self, members, alive):
        cells = real(self, members, alive)
        counts.append((cells.count(), members.filter("n > 16").count()))
        return cells

    monkeypatch.setattr(verified_copies._Search, "cells", counted)
    want = [(key, n, low, key == low) for key, n, low, _ in expected(rows)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), cell=16) == sorted(want, key=str)
    (made, of), = counts
    assert made < 3 * of

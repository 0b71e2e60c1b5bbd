"""Collocations from the de Bruijn graph, against counting all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickloom.llm import phrases
from clickloom.llm.phrases import Settings, collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(rows, settings):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        chosen = {gram: n for gram, n in f.items() if len(gram) > 1 and n >= settings.least}
        inside = set()
        for gram, n in chosen.items():
            if len(gram) == 3:
                inside |= {part for part in (gram[:2], gram[1:]) if part in chosen and 100 * n >= settings.percent * chosen[part]}
        best = []
        for gram, a in chosen.items():
            cuts = [(settings.scale * a * a // (f[gram[:k]] * f[gram[k:]]), k, f[gram[:k]], f[gram[k:]]) for k in range(1, len(gram))]
            score, _, left, right = min(cuts)
            if gram not in inside:
                best.append((-score, -a, " ".join(gram).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[: settings.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed=4):
    source, rows = random.Random(seed), []
    words = [f"w{n}" for n in range(60)] + ["New", "york", "É", "ä"]
    fixed = ["the quick brown fox jumps over a lazy dog", "New York", "state of the art", "x y x y x y x"]
    for _ in range(300):
        parts = []
        for _ in range(source.randint(0, 12)):
            own = source.choices(words, weights=[1 / (n + 1) for n in range(len(words))], k=source.randint(1, 7))
            if source.random() < 0.4:
                own.insert(source.randrange(len(own) + 1), source.choice(fixed))
            parts.append(source.choice([" ", "\t", "  "]).join(own))
        rows.append((source.choice([". ", ",", "\n", "!?", " "]).join(parts), source.choice(["en", "en", "de", None])))
    return [*rows, (None, "en"), ("", "en"), (" .,\t;", "fr"), *[("only one line of its own", "es")] * 12, ("one", "it")]


def found(df, settings):
    result = collocations(df, settings=settings)
    assert result.columns == COLUMNS
    return sorted(tuple(row) for row in result.collect())


@pytest.mark.parametrize(("settings", "chunk", "share"), [(Settings(), None, None), (Settings(least=2, top=40), 50, 20), (Settings(least=3, percent=90), 1000, 400)])
def test_collocations(spark, settings, chunk, share, monkeypatch):
    """Chunks of few words and a low bar for what counts as frequent give the same as one graph."""
    rows = corpus()
    if chunk:
        monkeypatch.setattr(phrases, "CHUNK", chunk)
        monkeypatch.setattr(phrases, "HOT_SHARE", share)
    df = spark.createDataFrame([(*row, 1, "p", 0) for row in rows], "text string, lang string, rank int, phrase string, x int").repartition(4)
    assert found(df, settings) == expected(rows, settings)


def test_words_that_split_edges(spark):
    """Frequent words and pairs are known before the edges are sent."""
    texts = spark.createDataFrame([("of the " + f"a{n} b{n}", "en") for n in range(9000)], "text string, lang string")
    facts, _ = phrases._facts_table(texts, Settings())
    words, pairs = phrases._frequent(facts)
    assert len(words) == 2 and len(pairs) == 1
    local = texts.coalesce(1).mapInArrow(phrases._local_edges(words, pairs), phrases.EDGES)
    parts = {row.part for row in local.select("part").distinct().collect()}
    assert len(parts) > phrases.SPLITS and max(parts) > phrases.SPLITS


def test_paths(spark):
    """Edges between which nothing enters or leaves are one path."""
    rows = [("a b c d e", "en")] * 12 + [("z b c q", "en")] * 11
    texts = spark.createDataFrame(rows, "text string, lang string")
    facts, _ = phrases._facts_table(texts, Settings())
    table, _ = phrases.graph(texts, facts, Settings())
    edges, nodes, _ = phrases._parts(table, Settings())
    paths, _ = phrases.unitigs(edges, nodes)
    names = {row.x: row.word for row in facts.filter("kind = 0").collect()}
    assert sorted(("".join(names[w] for w in row.words), row.f) for row in paths.collect()) == [("abc", 12), ("bcde", 12), ("bcq", 11), ("zbc", 11)]


def test_large_counts_are_exact(spark):
    df = spark.createDataFrame([(10**13 + 1, 10**13 + 7, 10**13 + 3), (3, 4, 5)], "a long, l long, r long")
    got = [row[0] for row in df.select(phrases._score(df.a, df.l, df.r, Settings())).collect()]
    assert got == [10**6 * a * a // (b * c) for a, b, c in [(10**13 + 1, 10**13 + 7, 10**13 + 3), (3, 4, 5)]]


def test_edges_of_equal_hashes(monkeypatch):
    """Edges whose hashes meet are still told apart."""
    x, y, z = (np.array(column, np.uint64) for column in ([1, 1, 1, 2, 1], [5, 6, 5, 5, 5], [9, 8, 9, 9, 7]))
    plain = sorted(zip(*(column.tolist() for column in phrases._added(x, y, z)), strict=True))
    monkeypatch.setattr(phrases, "mix", lambda values: values * np.uint64(0))
    assert sorted(zip(*(column.tolist() for column in phrases._added(x, y, z)), strict=True)) == plain == [(1, 5, 7, 1), (1, 5, 9, 2), (1, 6, 8, 1), (2, 5, 9, 1)]


def test_no_rows(spark):
    assert found(spark.createDataFrame([], "text string, lang string"), Settings()) == []
    assert found(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string"), Settings()) == []

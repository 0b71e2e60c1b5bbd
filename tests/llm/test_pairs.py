"""Similarity join, groups, nearest neighbours."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from clickloom.llm import jaccard, neighbours
from clickloom.llm.components import components
from tests.llm.test_filters import shingles

VOCABULARY = [f"w{n}" for n in range(500)]


def changed(source, words, count):
    words = list(words)
    for _ in range(count):
        words[source.randrange(len(words))] = source.choice(VOCABULARY)
    return words


def documents(seed=6):
    source = random.Random(seed)
    rows = [(n, " ".join(source.choices(VOCABULARY, k=source.choice([1, 4, 5, 40, 150])))) for n in range(40)]
    for base in range(8):
        words = source.choices(VOCABULARY, k=source.choice([60, 120, 400]))
        for n in range(12):
            rows.append((100 + base * 20 + n, " ".join(changed(source, words, source.choice([0, 0, 1, 2, 4])))))
    line = " ".join(source.choices(VOCABULARY, k=20))
    rows += [(400 + n, f"{line} {' '.join(source.choices(VOCABULARY, k=30))}") for n in range(60)]
    text = rows[60][1]
    rows += [(500, text.upper()), (501, text.replace(" ", ", ")), (501, text.replace(" ", ", ")), (None, text), (502, ""), (503, None), (504, " .,;")]
    # One key with several texts, each the first of its class.
    rows += [(-3, "one text of this key and more"), (-3, "another text of this key and more"), (-3, text), (505, "ANOTHER text of this key and more")]
    return [*rows, (506, "w1"), (507, "W1!"), (508, "w1 w2")]


def normal(text):
    import re

    return tuple(re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower()))


def expected(rows):
    """Group and links of each document, by comparing all pairs."""
    own = sorted({(key, text) for key, text in rows if key is not None and normal(text)}, key=str)
    sets = [shingles(text) for _, text in own]
    links = {n: set() for n in range(len(own))}
    for i in range(len(own)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared * 5 >= (len(sets[i]) + len(sets[j]) - shared) * 4:
                links[i].add(j)
                links[j].add(i)
    group = {}
    for n in links:
        todo, seen = [n], {n}
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        group[n] = min(own[m][0] for m in seen)
    out = {(own[n][0], own[n][1], group[n], len(links[n])) for n in links}
    return out | {(key, text, key, 0) for key, text in rows if key is None or not normal(text)}


@pytest.mark.parametrize("largest", [2048, 8])
def test_linked_documents(spark, largest):
    """With nodes of 8 sets the tree gets deep, and what stays large is compared in blocks."""
    rows = documents()
    df = spark.createDataFrame([(*row, "r", "c") for row in rows], "doc_id long, text string, row string, class string").repartition(5)
    settings = replace(jaccard.Settings(), largest_node=largest, levels=2)
    join = jaccard.similarity_join(df, settings=settings)
    linked = jaccard.linked_documents(join)
    by_row = df.selectExpr("xxhash64(text) AS row", "text").distinct()
    found = {(row.key, row.text, row.group, row.links) for row in linked.join(by_row, "row").collect()}
    assert found == expected(rows)
    # Each link between classes is found in one place.
    pairs = [(row.a, row.b) for row in join.pairs.collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    copies = {row["class"]: row.copies for row in join.classes.collect()}
    links = sum(2 * copies[a] * copies[b] for a, b in pairs) + sum(n * (n - 1) for n in copies.values())
    assert links == sum(row[3] for row in expected(rows))


def test_one_of_each_group(spark):
    rows = documents()
    df = spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], "doc_id long, text string, hash int").repartition(5)
    assert jaccard.one_of_each_group(df).columns == df.columns
    kept = [(row.doc_id, row.text) for row in jaccard.one_of_each_group(df).collect()]
    assert {row for row in kept if row[0] is None or not normal(row[1])} == {row for row in rows if row[0] is None or not normal(row[1])}
    groups = {}
    for key, text, group, _ in expected(rows):
        if key is not None and normal(text):
            groups.setdefault(_component(rows, key, text), []).append((key, text, group))
    judged = [row for row in kept if row[0] is not None and normal(row[1])]
    assert len(judged) == len(set(judged)) == len(groups)
    for members in groups.values():
        stays = [row for row in judged if row in {(key, text) for key, text, _ in members}]
        assert len(stays) == 1 and stays[0][0] == members[0][2]


def _component(rows, key, text):
    """A name of the component of a document."""
    cache = _component.__dict__.setdefault("cache", {})
    if not cache:
        own = sorted({(k, t) for k, t in rows if k is not None and normal(t)}, key=str)
        sets = {d: shingles(d[1]) for d in own}
        for d in own:
            if d in cache:
                continue
            todo = [d]
            cache[d] = d
            while todo:
                x = todo.pop()
                for y in own:
                    shared = len(sets[x] & sets[y])
                    if y not in cache and shared * 5 >= (len(sets[x]) + len(sets[y]) - shared) * 4:
                        cache[y] = d
                        todo.append(y)
    return cache[key, text]


@pytest.mark.parametrize("largest", [2048, 8])
def test_every_text_of_a_shared_key_has_near_copies(spark, largest):
    source = random.Random(8)
    families = []
    for n in range(6):
        words = source.choices(VOCABULARY, k=80)
        # The shared key is the smallest, and has its words twice in different writing; one word of 80 differs.
        own = [(-7, " ".join(words)), (-7, " ".join(words).upper())]
        own += [(100 * n + m, " ".join(changed(source, words, 1))) for m in range(4)]
        families.append(own)
    rows = [row for own in families for row in own]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    settings = replace(jaccard.Settings(), largest_node=largest, levels=2)
    linked = jaccard.linked_documents(jaccard.similarity_join(df, settings=settings))
    by_row = df.selectExpr("xxhash64(text) AS row", "text").distinct()
    found = linked.join(by_row, "row").collect()
    assert {(row.key, row.text, row.group, row.links) for row in found} == expected(rows)
    assert len(found) == len(rows) and {row.group for row in found} == {-7}
    kept = [(row.doc_id, row.text) for row in jaccard.one_of_each_group(df, settings=settings).collect()]
    assert all(sum(row in own for row in kept) == 1 for own in families) and len(kept) == len(families)
    assert {key for key, _ in kept} == {-7}


def test_join_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.linked_documents(jaccard.similarity_join(df)).count() == 0
    assert jaccard.one_of_each_group(df).count() == 0
    only = spark.createDataFrame([(1, None), (None, "a b")], "doc_id long, text string")
    assert jaccard.one_of_each_group(only).count() == 2


def test_estimates_and_runs_reach_the_recall():
    settings = jaccard.Settings()
    assert settings.runs >= 7 and len(settings.places) >= 20
    assert 0.6 * jaccard.LENGTH < settings.least_equal < 0.8 * jaccard.LENGTH


def test_ties_at_the_cut_go_to_the_smaller_id(monkeypatch):
    source = np.random.default_rng(3)
    vectors = np.unique(source.integers(0, 2, (1500, 12)), axis=0).astype(float)[1:]
    ids = source.permutation(len(vectors)) * 3
    settings = neighbours.Settings(confidence=1 - 1e-12, leaf=16)
    rows = pd.DataFrame({"shard": 0, "vector": list(vectors), "ids": [[n] for n in ids.tolist()]})
    longest = float((vectors**2).sum(1).max())
    index = pa.Table.from_pandas(neighbours._build(1.0, longest, settings)(rows))
    monkeypatch.setattr(neighbours, "read_part", lambda *_: index)
    neighbours._shard.cache_clear()
    asked = pd.DataFrame({"query_id": ids[:40], "vector": list(vectors[:40])})
    found = neighbours._search("ties", 1.0, longest, 20, settings)((0, 0, 12), asked)
    neighbours._shard.cache_clear()
    for query_id, vector in zip(asked["query_id"], asked["vector"], strict=True):
        best = sorted((-score, n) for n, score in zip(ids.tolist(), (vectors @ vector).tolist(), strict=True) if n != query_id)
        own = found[found["query_id"] == query_id]
        assert list(zip(own["score"] * -1, own["vec_id"], strict=True)) == best[:20]


def test_more_places_than_a_mask_holds_are_refused():
    for settings in (jaccard.Settings(similarity=0.2), jaccard.Settings(similarity=0.5, recall=1 - 1e-9)):
        with pytest.raises(ValueError, match="places"):
            settings.places  # noqa: B018


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    source = random.Random(1)
    links = {
        "path": [(n, n + 1) for n in range(60)],
        "star": [(0, n) for n in range(1, 80)],
        "random": [(source.randrange(80), source.randrange(80)) for _ in range(50)],
        "none": [],
    }[shape]
    found = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: root(n) for n in linked}


# Nearest neighbours -----------------------------------------------------------------------------------------


def brute(rows, queries, count):
    usable = [(n, np.array(v, float)) for n, v in rows if n is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for query in queries:
        for n, v in usable:
            if n != query:
                continue
            found = sorted({(-(w * v).sum(), m) for m, w in usable if m != query and len(w) == len(v)})
            out[query] = [(m, -s) for s, m in found[:count]]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(n, v, 1, "b") for n, v in rows], "vec_id long, embedding array<double>, shard int, block string")


def test_nearest_with_odd_rows(spark):
    source = np.random.default_rng(2)
    rows = [(n, source.integers(-3, 4, 6).astype(float).tolist()) for n in range(120)]
    rows += [(200 + n, [1.0, 2.0, 0.0, 0.0, 1.0, 5.0]) for n in range(40)] + [(200, [1.0, 2.0, 0.0, 0.0, 1.0, 5.0])]
    rows += [(300, None), (320, [0.0] * 6), (340, [float("nan")] * 6), (360, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (380, [float("inf")] * 6), (400, [])]
    rows += [(None, [1.0] * 6), (420, [1e150] * 6), (440, [1.0, 2.0]), (441, [2.0, 1.0]), (460, [1.0, 2.0, 3.0])]
    df = vectors(spark, rows)
    queries = [n for n, _ in rows if n is not None and n % 20 == 0]
    settings = neighbours.Settings(dimensions=4, confidence=1 - 1e-12, leaf=4, shard_rows=30, block_rows=3)
    found = {}
    for row in neighbours.nearest(df.repartition(5), df.filter("vec_id % 20 = 0"), settings=settings).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(found[row.query_id])
    expected = brute(rows, queries, 20)
    assert found == {query: rows for query, rows in expected.items() if rows}


def test_nearest_recall(spark):
    source = np.random.default_rng(3)
    centres = source.normal(size=(20, 32))
    data = centres[source.integers(0, 20, 3000)] + source.normal(size=(3000, 32)) * 0.5
    rows = [(n, v.tolist()) for n, v in enumerate(data)]
    df = vectors(spark, rows)
    found = neighbours.nearest(df, df.filter("vec_id % 50 = 0"), settings=neighbours.Settings(shard_rows=1000)).collect()
    hits = 0
    for query in range(0, 3000, 50):
        scores = data @ data[query]
        scores[query] = -np.inf
        top = set(np.argsort(-scores)[:20].tolist())
        hits += len(top & {row.vec_id for row in found if row.query_id == query})
    assert len(found) == 60 * 20 and hits >= 0.95 * 60 * 20


def test_recall_and_share_of_vectors_verified(spark):
    """On the given vectors: recall of at least 0.9, and little more than half of the vectors verified for a query (fewer in larger shards)."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = rows.filter(neighbours.usable(rows.embedding)).toPandas().sort_values("vec_id")
    rows["vector"] = [tuple(v) for v in rows["embedding"]]
    distinct = rows.groupby("vector")["vec_id"].agg(list).reset_index()
    data = np.array(distinct["vector"].tolist(), float)
    scale = np.abs(data).max()
    longest = ((data / scale) ** 2).sum(1).max()
    settings = neighbours.Settings()
    frame = pd.DataFrame({"shard": 0, "vector": list(data), "ids": distinct["vec_id"]})
    index = neighbours._build(scale, longest, settings)(frame).iloc[0].to_dict()
    shard = neighbours._Shard(index, data.shape[1], settings)
    look = neighbours._looks(shard, data.shape[1], scale, longest, 20, settings)
    asked = [n for n, ids in enumerate(distinct["vec_id"]) if any(i % 20 == 0 for i in ids)]
    hits = 0
    for n in asked:
        best, _ = look(data[n])
        edge = np.sort(data @ data[n])[-21]
        hits += int((shard.vectors[best] @ data[n] >= edge - 1e-9).sum())
    assert hits >= 0.9 * 21 * len(asked)
    assert shard.verified <= 0.55 * len(data) * len(asked), shard.verified / len(data) / len(asked)


def test_nearest_of_nothing(spark):
    none = vectors(spark, [])
    some = vectors(spark, [(1, [1.0, 2.0])])
    assert neighbours.nearest(none, none).count() == 0
    assert neighbours.nearest(some, none).count() == 0
    assert neighbours.nearest(some, some).count() == 0


def test_chi_square():
    assert neighbours.chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert neighbours.stop_ratio(neighbours.Settings(dimensions=2, confidence=0.95)) == pytest.approx(5.991, abs=1e-3)

"""Word2Vec in blocks: companions, means, independence of the number of tasks, no model on the driver."""

from __future__ import annotations

import os
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from clickloom.functions import blocked_word2vec
from clickloom.functions.blocked_word2vec import BlockedSettings, fit, pair_counts
from clickloom.plans import vectors
from tests.conftest import plan_of, rows_of

SMALL = BlockedSettings(vector_size=16, block_words=25, epochs=12, window=3)


def sentences(count=1500, topics=12, seed=2):
    """Words a<n> and b<n> stand in the same places: they are companions."""
    source = random.Random(seed)
    rows = []
    for _ in range(count):
        n = source.randrange(topics)
        own = [f"c{n}x{source.randrange(4)}" for _ in range(4)]
        own.insert(2, source.choice([f"a{n}", f"b{n}"]))
        rows.append((own,))
    return rows


def test_companions_are_nearest(spark):
    tokens = spark.createDataFrame(sentences(), "words array<string>").repartition(4)
    model = fit(tokens, SMALL, "words")
    assert model.count > 2
    rows = model.vectors().collect()
    words = [row.word for row in rows]
    table = np.array([row.vector for row in rows])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    pairs = [n for n, word in enumerate(words) if word[0] in "ab"]
    right = 0
    for n in pairs:
        near = [m for m in pairs if m != n]
        best = max(near, key=lambda m: table[n] @ table[m])
        right += words[best][1:] == words[n][1:]
    assert right >= 0.9 * len(pairs)


def test_same_model_for_any_layout(spark):
    rows = sentences(300)
    first, second = (
        {row.word: row.vector for row in fit(spark.createDataFrame(rows, "words array<string>").repartition(n), replace(SMALL, epochs=2), "words").vectors().collect()}
        for n in (1, 7)
    )
    assert first == second


def test_pairs_within_the_window(spark):
    rows = [(["x", "y", "x", "z"],), (["y"],), ([],)]
    got = pair_counts(spark.createDataFrame(rows, "words array<string>"), "words", 2)
    names = {row[0]: row[1] for row in spark.createDataFrame([(w,) for w in "xyz"], "w string").selectExpr("xxhash64(w)", "w").collect()}
    want = Counter()
    for (words,) in rows:
        for i, w in enumerate(words):
            want.update((w, words[j]) for j in range(max(0, i - 2), min(len(words), i + 3)) if j != i)
    assert {(names[r.w], names[r.c]): r.n for r in got.collect()} == want


@pytest.mark.parametrize("text_rows", [1_000_000, 3])
def test_means_over_all_words(spark, text_rows):
    """Unknown words count in the divisor; texts without words get zeros; hot blocks are handed out in parts."""
    settings = replace(SMALL, epochs=1, min_count=2, text_rows=text_rows)
    texts = ["red shirt", "red hat", "shirt red red", "blue", "", None, "the of", "red shirt", "new new red"]
    df = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "id long, name string").repartition(3)
    tokens = vectors.word_tokens(df, "name")
    model = fit(tokens, settings, "_words")
    known = {row.word: np.array(row.vector) for row in model.vectors().collect()}
    assert set(known) == {"red", "shirt", "new"}
    out = vectors.word2vec_vectors(df, "name", settings, model)
    assert out.columns == ["id", "name", "vector"]
    for row in out.collect():
        words = [w for w in (row.name or "").split() if w not in ("the", "of")]
        want = sum((known.get(w, np.zeros(16)) for w in words), np.zeros(16)) / max(1, len(words))
        assert np.allclose(row.vector, want, atol=1e-6)
    assert out.count() == len(texts)


def test_no_table_of_vectors_reaches_the_driver(spark, monkeypatch):
    """Neither training nor transforming collects rows with vectors, or broadcasts them."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen = []
    for name in ("collect", "toPandas", "toArrow", "first"):
        real = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *a, _real=real, **k: (seen.append(self.columns), _real(self, *a, **k))[1])
    model = fit(spark.createDataFrame(sentences(200), "words array<string>"), replace(SMALL, epochs=1), "words")
    model.transform(spark.createDataFrame(sentences(50), "words array<string>"), "words", "vector").count()
    assert seen and not any({"vector", "vectors", "sums"} & set(columns) for columns in seen)


def test_words_are_needed(spark):
    with pytest.raises(ValueError, match="min_count"):
        fit(spark.createDataFrame([(["a"],)], "words array<string>"), replace(SMALL, min_count=2), "words")
    with pytest.raises(TypeError):
        fit(spark.createDataFrame([("a",)], "words string"), SMALL, "words")


def test_gradient_steps_lower_the_loss():
    source = np.random.default_rng(1)
    row = {"words": np.arange(4).tobytes(), "counts": np.ones(4, np.int64).tobytes(), "squares": np.full(4, 1e-6, np.float32).tobytes()}
    block = blocked_word2vec._Block(row | {"vectors": source.random((4, 8), np.float32).tobytes()}, 8)
    goal = source.random((4, 8), dtype=np.float32)
    before = ((block.vectors - goal) ** 2).sum()
    for _ in range(50):
        block.step(np.array([0, 1, 1, 3]), (block.vectors - goal)[[0, 1, 1, 3]], 0.1)
    assert ((block.vectors - goal) ** 2)[[0, 1, 3]].sum() < 0.05 * before


@pytest.mark.parametrize("text_rows", [1_000_000, 4])
def test_means_beyond_the_head(spark, text_rows):
    """Words that are not handed to every part of the texts get their vectors from their blocks."""
    settings = replace(SMALL, epochs=1, min_count=2, text_rows=text_rows, head_words=15, block_words=40)
    rows = [(words + ["common"] * 2 + [f"once{n}"],) for n, (words,) in enumerate(sentences(150))] + [([],), (["unheard"],), (None,)]
    texts = spark.createDataFrame(rows, "words array<string>").repartition(3)
    model = fit(texts, settings, "words")
    head = model._head()
    assert model.count > 1 and 0 < len(head) <= 15 < model.size
    known = {row.word: np.array(row.vector) for row in model.vectors().collect()}
    assert not any(word.startswith("once") for word in known)
    out = model.transform(texts, "words", "vector").collect()
    assert sorted(repr(row.words) for row in out) == sorted(repr(words) for (words,) in rows)
    for row in out:
        words = row.words or []
        want = sum((known.get(w, np.zeros(16)) for w in words), np.zeros(16)) / max(1, len(words))
        assert np.allclose(row.vector, want, atol=1e-6)
    # Arrays without nulls, and no texts at all.
    assert model.transform(spark.range(3).selectExpr("id", "array('common') AS words"), "words", "vector").filter("vector[0] <> 0").count() == 3
    assert model.transform(texts.limit(0), "words", "vector").collect() == []


def test_words_that_are_in_no_vocabulary_are_left_out_of_the_pairs(spark):
    tokens = spark.createDataFrame([(["a", f"x{n}", "b"],) for n in range(500)], "words array<string>")
    vocabulary = spark.createDataFrame([("a", 500), ("b", 500)], "word string, n long")
    known = blocked_word2vec._Known.of(vocabulary, 2)
    assert known.bits.nbytes == 4096
    counts = blocked_word2vec._half_counts(tokens, "words", 2, known)
    assert counts.count() < 50 and counts.agg({"n": "max"}).first()[0] == 500


def test_combined_vectors_keep_no_model_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(vectors, "Word2Vec", None)
    assert vectors.COMBINED_SETTINGS.min_count == 10 and vectors.COMBINED_SETTINGS.vector_size == vectors.DIMENSION
    rows = [("t", "view", f"p{n // 2}", "c", "b", "1.0", "u", f"s{n}", "red ring") for n in range(24)] + [(None,) * 9] * 2
    df = spark.createDataFrame(
        rows, "event_time string, event_type string, product_id string, category_code string, brand string, price string, user_id string, user_session string, name string"
    )
    found = vectors.combined_vectors(df).collect()
    assert sorted((row.product_id or "", any(row.vector), len(row.vector)) for row in found) == sorted((row[2] or "", row[2] is not None, 128) for row in rows)


def test_means_are_added_where_the_texts_are(spark):
    """No shuffle and no table of sums or texts: both would hold a vector or more for each text."""
    settings = replace(SMALL, epochs=1, head_words=15, block_words=40)
    texts = spark.createDataFrame(sentences(150), "words array<string>").repartition(3).localCheckpoint()
    model = fit(texts, settings, "words")
    assert model.count > 1 and len(model._head()) < model.size
    out = model.transform(texts, "words", "vector")
    assert "Exchange" not in plan_of(out)
    assert all(len(row.vector) == 16 for row in out.collect())


def test_tables_of_the_combined_job(spark):
    """Its tokens are kept once, without the texts they are from, and of the model the word vectors alone."""
    from pathlib import Path

    kept = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(kept.iterdir())
    rows = [("t", "view", f"p{n // 2}", "c", "b", "1.0", "u", f"s{n}", "red ring") for n in range(24)]
    df = spark.createDataFrame(rows, "event_time string, event_type string, product_id string, category_code string, brand string, price string, user_id string, user_session string, name string")
    out = vectors.combined_vectors(df)
    tables = {file.parent: spark.read.parquet(str(file.parent)).columns for folder in set(kept.iterdir()) - before for file in folder.rglob("*.parquet")}
    assert sorted(map(tuple, tables.values())) == [("product_id", "_words"), ("word", "n"), ("words", "vectors"), ("words", "vectors")]
    assert out.count() == 24


def test_pairs_in_slices(spark):
    """Each pair is in one slice, and the model is the same."""
    tokens = spark.createDataFrame(sentences(200), "words array<string>").localCheckpoint()
    one = pair_counts(tokens, "words", 3)
    parts = [blocked_word2vec._either_way(blocked_word2vec._half_counts(tokens, "words", 3, None, n, 4)) for n in range(4)]
    assert all(part.count() > one.count() / 8 for part in parts)
    assert sorted(rows_of(one)) == sorted(row for part in parts for row in rows_of(part))
    whole, sliced = (rows_of(fit(tokens, replace(SMALL, epochs=1, slice_pairs=n), "words").vectors()) for n in (10**9, 1000))
    assert whole == sliced


def test_blocks_are_not_shuffled(spark, monkeypatch):
    """A round deals out pairs alone; tasks read the blocks by themselves. No table of a round is kept."""
    from clickloom.operators.saved import Scratch

    plans, folders, real = [], [], Scratch.saved
    monkeypatch.setattr(Scratch, "saved", lambda self, df, *a, **k: (plans.append(plan_of(df)), folders.append(self.folder), real(self, df, *a, **k))[2])
    model = fit(spark.createDataFrame(sentences(50), "words array<string>"), replace(SMALL, epochs=1), "words")
    rounds = [plan for plan in plans if "squares" in plan and "cell" in plan]
    assert len(rounds) == model.count > 1
    assert all(plan.count("Exchange") == 1 and "vectors" not in plan[plan.index("Exchange"):] for plan in rounds)
    assert [os.path.isdir(folder) for folder in (folders[0], folders[-1])] == [True, False]

"""The corpus pipeline, its stages against brute force, and the registered queries."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.test_filters import shingles, without_repeats
from tests.llm.test_outputs import plain_ids

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, rows):
    return spark.createDataFrame([(key, text, "en", "s", len(text or "")) for key, text in rows], DOCUMENTS)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with one planted case of each kind."""
    source = random.Random(21)
    syllables = ["an", "er", "th", "on", "in", "ed", "re", "ou"]
    word = lambda: "".join(source.choices(syllables, k=source.randint(2, 5)))
    prose = lambda count: " ".join(word() for _ in range(count))
    rows = [(n, prose(source.randint(40, 200))) for n in range(200)]
    toxic = []
    for n in range(200, 260):
        words = prose(100).split()
        for place in range(0, 100, 20):
            words[place] = "vileword"
        rows.append((n, " ".join(words)))
        toxic.append(n)
    rows += [(300, rows[0][1]), (301, rows[1][1] + " more")]
    passage = prose(60)
    rows += [(310 + n, f"{prose(40)} {passage} {prose(40)}") for n in range(3)]
    item = prose(30)
    rows += [(320, f"{prose(50)} {item} {prose(50)}"), (330, None), (331, ""), (332, prose(9000))]
    path = tmp_path_factory.mktemp("corpus")
    corpus(spark, rows).repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(n, 1, int(n in toxic)) for n, _ in rows if n < 260]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, toxic, passage


def test_stages(spark, folder):
    path, rows, toxic, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, path)
        assert docs.schema.simpleString() == before.schema.simpleString()
        kept[name] = {row.doc_id: row.text for row in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    everything = dict(rows)
    assert kept["toxicity"] == {n: text for n, text in rows if n not in toxic}
    assert set(kept["toxicity"]) - set(kept["near_copies"]) == {300, 301}
    expected = {}
    for key, words, removed, text in without_repeats([(n, everything[n]) for n in kept["near_copies"]], 13):
        if not words or removed < words:
            expected[key] = text if removed else everything[key]
    assert kept["repeated_passages"] == expected
    assert passage in expected[310] and not shingles(passage, 13) & shingles(expected[311], 13)
    assert set(kept["repeated_passages"]) - set(kept["decontamination"]) == {320}
    placed = corpus_pipeline.pack(spark, docs, path).collect()
    ids = {}
    for row in sorted(placed, key=lambda row: row.piece):
        ids[row.doc_id] = ids.get(row.doc_id, b"") + bytes(row.ids)
    import numpy as np

    assert {key: np.frombuffer(own, "<u4").tolist() for key, own in ids.items()} == {
        key: plain_ids(text, 0) for key, text in kept["decontamination"].items()
    }


def test_run_and_empty_corpus(spark, folder, tmp_path):
    path, rows, *_ = folder
    found = corpus_pipeline.run(spark, path).select("doc_id").distinct().count()
    assert 0 < found < len(rows)
    corpus(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = driver.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_repeated_and_null_rows_pass_through_all_stages(spark, folder):
    path, *_ = folder
    rows = [(1, "a b c"), (1, "a b c"), (1, "other words"), (None, "a b c"), (None, None), (2, None), (2, None), (3, "x" * 100_000)]
    docs = corpus(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
    found = sorted(((row.doc_id, row.text) for row in docs.collect()), key=str)
    # Repeated rows go with the near copies; rows without id or text stay.
    assert found == sorted([(1, "a b c"), (1, "other words"), (None, "a b c"), (None, None), (2, None), (3, "x" * 100_000)], key=str)


def test_columns_may_have_any_name(spark, folder):
    """Extra columns that are called like the stages' own ones pass through all of them unchanged."""
    path, rows, _, _ = folder
    names = ["score", "others", "key", "row", "label", "n_words", "extra"]
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id < 40").selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 30
    assert all(getattr(row, n) == f"{n}{row.doc_id}" for row in docs.collect() for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() >= docs.count()

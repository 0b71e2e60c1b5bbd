"""Substrings, contamination, toxicity, URLs."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import contamination, substrings, toxicity, urls

WORDS = ["ab", "cd,", "ef.", "Gh", "éé", "中", "x\x1cy"]


def prose(source, count):
    return " ".join(source.choices(WORDS, k=count))


# Repeated substrings ----------------------------------------------------------------------------------------


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(rows, size):
    first = {}
    for key, text in rows:
        words = split(text)
        for n in range(len(words) - size + 1):
            own = tuple(words[n : n + size])
            rank = math.inf if key is None else key
            first[own] = min(first.get(own, rank), rank)
    out = []
    for key, text in rows:
        words, gone = split(text), set()
        for n in range(len(words) - size + 1):
            if first[tuple(words[n : n + size])] < (math.inf if key is None else key):
                gone |= set(range(n, n + size))
        out.append((key, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(out, key=str)


def repeated_rows():
    source = random.Random(8)
    passage = " ".join(f"p{n}" for n in range(30))
    rows = [(n, prose(source, source.randint(0, 60))) for n in range(40)]
    rows += [(50 + n, f"{prose(source, 5)}\t\n{passage}  {prose(source, 5)} ") for n in range(10)]
    rows += [(70, passage), (70, passage), (71, None), (None, passage), (72, "same " * 40), (73, "same " * 20), (74, ""), (-5, passage[:50])]
    return [*rows, (75, " ".join(f"w{n}" for n in range(5000))), (76, "w " + " ".join(f"w{n}" for n in range(2500, 5000)))]


@pytest.mark.parametrize("size", [3, 13])
def test_remove_repeated(spark, size, monkeypatch):
    rows = repeated_rows()
    df = spark.createDataFrame([(*row, "k", 1) for row in rows], "doc_id long, text string, part string, hash int").repartition(6)
    found = substrings.remove_repeated(df, size=size, keep=["doc_id", "part", "hash"]).collect()
    assert sorted(((row.key, row.n_words, row.n_removed, row.kept) for row in found), key=str) == without_repeats(rows, size)
    assert sorted(((row.extra.doc_id, row.text) for row in found), key=str) == sorted(rows, key=str)
    assert all((row.extra.part, row.extra.hash) == ("k", 1) for row in found)


def test_sketch_loses_nothing_with_many_blocks_and_flushes(spark, monkeypatch):
    rows = repeated_rows()
    monkeypatch.setattr(substrings, "_PER_BLOCK", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substrings.remove_repeated(df, size=5).collect()
    assert sorted(map(tuple, found), key=str) == without_repeats(rows, 5)


def test_null_keys_lose_to_the_last_key(spark):
    words = " ".join(f"w{n}" for n in range(20))
    last = 2**63 - 1
    rows = [(None, words), (last, words), (None, words), (None, words + " tail"), (None, "x " * 30), (None, "x " * 30)]
    found = substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((row.key is None, row.n_words, row.n_removed) for row in found) == sorted(
        [(False, 20, 0), (True, 20, 20), (True, 20, 20), (True, 21, 20), (True, 30, 0), (True, 30, 0)]
    )


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_windows_of_one_hash_are_told_apart_by_their_checks(monkeypatch, bits):
    plain = substrings._Windows.hashes
    # All but a few bits of the first hash are lost, so most windows collide.
    monkeypatch.setattr(
        substrings._Windows, "hashes", lambda self, lane: plain(self, lane) if lane else plain(self, 0) & np.uint64((1 << bits) - 1)
    )
    source = random.Random(bits)
    texts = [" ".join(source.choice("abcde") for _ in range(source.randint(0, 30))) for _ in range(80)]
    keys = [source.choice([None, *range(60)]) for _ in texts]
    parts = sorted(source.randrange(4) for _ in texts)
    batch = pa.record_batch([pa.array(texts), pa.array(parts, pa.int64()), pa.array(keys, pa.int64())], ["text", "part", "key"])
    tables: dict[str, pd.DataFrame] = {}

    def read(folder, column, part, names):
        rows = tables[folder][tables[folder][column] == part]
        return pa.table({name: pa.array(rows[name].tolist()) for name in names}) if len(rows) else None

    def grouped(rows, by, function):
        return pd.concat([function(own.reset_index(drop=True)) for _, own in rows.groupby(by)], ignore_index=True)

    monkeypatch.setattr(substrings, "read_part", read)
    size, width, blocks = 4, 16, 0
    sketch = pd.concat(one.to_pandas() for one in substrings._sketch(size, width, blocks)(iter([batch])))
    tables["cells"] = grouped(sketch, ["lane", "block"], substrings._merge_cells)
    found = pd.concat(one.to_pandas() for one in substrings._candidates(size, width, blocks, "cells")(iter([batch])))
    tables["firsts"] = grouped(found, ["block"], substrings._first_documents)
    removed = [n for one in substrings._removal(size, "firsts", False, [])(iter([batch])) for n in one.column(2).to_pylist()]

    windows = [[tuple(text.split()[n : n + size]) for n in range(len(text.split()) - size + 1)] for text in texts]
    owners: dict[tuple, set] = {}
    for key, own in zip(keys, windows, strict=True):
        for window in own if key is not None else []:
            owners.setdefault(window, set()).add(key)
    for key, own, count in zip(keys, windows, removed, strict=True):
        lost = [n for n, window in enumerate(own) if window in owners and (key is None or min(owners[window]) < key)]
        assert count == len({n + m for n in lost for m in range(size)})


def test_remove_repeated_from_nothing(spark):
    assert substrings.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Contamination ----------------------------------------------------------------------------------------------


def shingles(text, size=5):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())
    return {" ".join(words[n : n + size]) for n in range(max(1, len(words) - size + 1))} if words else set()


def test_contained_items(spark):
    source = random.Random(9)
    vocabulary = [f"w{n}" for n in range(400)]
    text = lambda count: " ".join(source.choices(vocabulary, k=count))
    items = [(n, text(source.randint(6, 40))) for n in range(30)]
    items += [(40, "one two"), (41, ""), (42, None), (None, text(20)), (3, text(15)), (3, items[3][1]), (43, "The the THE the the the")]
    documents = [(n, text(source.choice([0, 3, 30, 800]))) for n in range(60)]
    for n in range(60, 110):
        passage = source.choice(items)[1] or ""
        words = passage.split()
        if source.random() < 0.5 and len(words) > 8:
            words[source.randrange(len(words))] = "changed"
        documents.append((n, f"{text(source.choice([5, 3000]))} {' '.join(words).upper()}; {text(20)}"))
    documents += [(None, items[0][1]), (60, documents[60][1]), (60, items[1][1]), (200, None), (201, "One, two!"), (202, "one two three")]
    expected = set()
    for key, body in documents:
        own = shingles(body)
        for item, wanted in items:
            need = shingles(wanted)
            if need and len(need & own) * 5 >= len(need) * 4:
                expected.add((key, item, len(need & own), len(need)))
    df = spark.createDataFrame([(*d, "r", "n") for d in documents], "doc_id long, text string, row string, number string").repartition(5)
    found = contamination.contained_items(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(row.key, row.item, row.shared, row.total) for row in found.collect()} == expected
    kept = contamination.without_items(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    gone = {body for key, body in documents if any((n := shingles(w)) and len(n & shingles(body)) * 5 >= len(n) * 4 for _, w in items)}
    assert sorted(((row.doc_id, row.text) for row in kept), key=str) == sorted((d for d in documents if d[1] not in gone), key=str)


def test_sketches_by_size_class(spark):
    """The sketches of a class are equally long, and no item changes those of another."""
    sizes = [1, 2, 5, 8, 11, 15, 16, 31, 40, 63]
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n + 4))) for n in sizes]
    df = spark.createDataFrame(items, "number long, text string").withColumn("words", contamination.words("text"))
    df = df.withColumn("shingles", contamination._shingles(5))
    settings = contamination.Settings()
    df = df.withColumn("needed", contamination._needed(F.size("shingles"), settings))

    def found(rows):
        grouped = contamination.sketches(rows, settings).groupBy("number", "needed", "enough").count()
        return {row.number: (row.needed, row.enough, row["count"]) for row in grouped.collect()}

    every = found(df)
    assert {n: every[n][0] for n in sizes} == {n: -(-n * 4 // 5) for n in sizes}
    for n in sizes:
        top = 2 ** n.bit_length() - 1
        assert every[n][2] == min(n, top - -(-top * 4 // 5) + 2)
        assert every[n][1] == max(1, every[n][2] - (n - every[n][0]))
    assert found(df.filter("number >= 16")) == {n: every[n] for n in sizes if n >= 16}


@pytest.mark.parametrize("changed", [{"broadcast_rows": 0}, {"most_slots": 1 << 10, "slots": 1}, {"matches": 9}])
def test_contained_items_whatever_the_settings(spark, changed):
    source = random.Random(4)
    text = lambda count: " ".join(source.choices([f"w{n}" for n in range(300)], k=count))
    items = [(n, text(5 + n)) for n in range(60)]
    documents = [(n, f"{text(source.choice([0, 900]))} {items[n % 60][1]} {text(5)}") for n in range(90)]
    # Shingles of an item that are spread over a long text count as well.
    words = items[50][1].split()
    documents.append((90, " . ".join(" ".join(words[i : i + 5]) for i in source.sample(range(len(words) - 4), len(words) - 4))))
    df = spark.createDataFrame(documents, "doc_id long, text string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contained_items(df, wanted, settings=contamination.Settings(**changed)).collect()
    expected = {
        (key, item)
        for key, body in documents
        for item, wanted in items
        if len(shingles(wanted) & shingles(body)) * 5 >= len(shingles(wanted)) * 4
    }
    assert {(row.key, row.item) for row in found} == expected and (90, 50) in expected


def test_contamination_of_empty_tables(spark):
    some, none = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert contamination.contained_items(some, none).count() == 0
    assert contamination.contained_items(some.limit(0), some.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert contamination.without_items(some, none).count() == 1


def test_contamination_runs_in_the_engine(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = contamination.contained_items(df, df.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Toxicity ---------------------------------------------------------------------------------------------------


def toxic_rows(count=1500):
    source = random.Random(3)
    syllables = ["an", "er", "th", "on", "in", "ed", "re", "ou", "st", "le"]
    word = lambda: "".join(source.choices(syllables, k=source.randint(1, 4)))
    rows = []
    for n in range(count):
        toxic = n % 7 == 0
        words = [word() for _ in range(source.randint(20, 120))]
        if toxic:
            for _ in range(1 + len(words) // 30):
                words.insert(source.randrange(len(words)), source.choice(["vileword", "nastyone", "hatething"]))
        rows.append((n, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = toxic_rows()
    documents = spark.createDataFrame([(n, text, "en") for n, text, _ in rows], "doc_id long, text string, label string")
    labels = [(n, toxic) for n, _, toxic in rows] + [(None, 1), (5, None), (6, 7), (99999, 1), (1, 0), (1, 0)]
    return toxicity.fit(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, model):
    rows = toxic_rows()
    documents = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.score(documents, model, keep=["doc_id", "toxic"])
    held = [row for row in scored.withColumn("held", toxicity.held_out()).collect() if row.held]
    assert {row.doc_id for row in held} == {n for n, _, _ in rows if zlib.crc32(str(n).encode()) % 5 == 0}
    assert sum((row.score >= 0.5) == (row.toxic == 1) for row in held) >= 0.98 * len(held)


def test_held_out_labels_do_not_matter(spark, model):
    rows = toxic_rows()
    documents = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    flipped = [(n, 1 - toxic if zlib.crc32(str(n).encode()) % 5 == 0 else toxic) for n, _, toxic in rows]
    again = toxicity.fit(documents, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert again.grams.tolist() == model.grams.tolist()
    assert again.weights.tolist() == pytest.approx(model.weights.tolist())


def test_odd_texts_get_scores(spark, model):
    rows = [(1, None), (2, ""), (3, "a"), (None, "vileword " * 5), (5, "x" * 300_000), (5, "x" * 300_000), (6, "İ\ud7ff😀")]
    found = toxicity.score(spark.createDataFrame(rows, "doc_id long, score string"), model, text="score", keep=["doc_id"]).collect()
    assert sorted((row.doc_id for row in found), key=str) == sorted((n for n, _ in rows), key=str)
    assert all(0 <= row.score <= 1 for row in found)
    assert next(row.score for row in found if row.doc_id is None) > 0.5


def test_the_sample_is_bounded_in_rows(spark, monkeypatch):
    """Few labels whose keys have very many rows, copies and different texts alike."""
    sizes = []
    real = toxicity.stages.written
    monkeypatch.setattr(toxicity.stages, "written", lambda df, *a, **k: (lambda out: (sizes.append(out[0].count()), out)[1])(real(df, *a, **k)))
    documents = spark.range(20_000).select((F.col("id") % 10 + 1).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 4000).alias("text"))
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 11)], "doc_id long, toxic int")
    toxicity.fit(documents, labels, settings=replace(toxicity.Settings(), sample_rows=100))
    assert 40 < sizes[0] < 200


def test_fit_without_labels(spark):
    documents = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = toxicity.fit(documents, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(documents, model).first().score == 0.5
    assert toxicity.score(documents.limit(0), model).count() == 0


# URLs -------------------------------------------------------------------------------------------------------

RULES = [urls.Rule("org", "/", True), urls.Rule("example.org", "/es/", False), urls.Rule("com", "/fr/", True), urls.Rule("com", "/de/", False)]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(url):
    host, path = parts(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def ratios(rows, order=5, alphabet=256):
    """Log-likelihood differences by the definition: counts of the URLs that are learnt from, Witten-Bell."""
    import hashlib

    counts = {True: Counter(), False: Counter()}
    for url in rows:
        rule = rule_of(url)
        text = url or ""
        if rule and text and hashlib.md5(text.encode()).hexdigest()[0] not in "012":
            padded = "\x02" * (order - 1) + text
            for n in range(len(text)):
                counts[rule.allow][padded[n : n + order]] += 1
    tables = {}
    for side, found in counts.items():
        context, kinds, grams = defaultdict(int), defaultdict(set), defaultdict(int)
        for gram, n in found.items():
            for k in range(1, order + 1):
                tail = gram[-k:]
                grams[tail] += n
                context[k, tail[:-1]] += n
                kinds[k, tail[:-1]].add(tail[-1])
        tables[side] = grams, context, kinds

    def probability(side, gram):
        grams, context, kinds = tables[side]
        p = 1 / alphabet
        for k in range(1, order + 1):
            tail = gram[-k:]
            total, kind = context[k, tail[:-1]], len(kinds[k, tail[:-1]])
            if total:
                p = (grams[tail] + kind * p) / (total + kind)
        return p

    def score(url):
        padded = "\x02" * (order - 1) + url
        each = [padded[n : n + order] for n in range(len(url))]
        return sum(math.log(probability(True, g)) - math.log(probability(False, g)) for g in each) / len(url)

    return score


def url_rows():
    source = random.Random(12)
    made = []
    for _ in range(400):
        host = source.choice(["", "www.", "m."]) + source.choice(["ab", "cd", "ef"]) + source.choice([".example.org", ".example.com", ".example.net"])
        made.append(f"http{source.choice(['', 's'])}://{host}/{source.choice(['fr', 'de', 'es', 'en'])}/{source.randint(1, 999)}{source.choice(['', '?a=b', '#x', '/'])}")
    odd = [None, "", "no url", "://", "http://", "HTTP://EXAMPLE.ORG/es/1", "http://example.org?x://y/z", "a://b://c/d", "http://ÉX.org/", "http://xorg/", "x\ny://Q.com/fr/\n?"]
    return [*made, *odd, "http://hot.example.com/de/1", *["http://hot.example.com/de/1"] * 50, "http://a.net/" + "z" * 5000]


def test_judge(spark):
    rows = url_rows()
    df = spark.createDataFrame([(n, url, "h") for n, url in enumerate(rows)], "page_id long, url string, host string").repartition(5)
    found = urls.judge(df, RULES).collect()
    assert sorted(row.key for row in found) == list(range(len(rows)))
    score = ratios(rows)
    steps = set()
    for row in found:
        assert (row.host, row.path) == parts(rows[row.key])
        rule = rule_of(rows[row.key])
        assert row.rule == (rule.name if rule else None)
        expected = score(rows[row.key]) if rows[row.key] else 0.0
        assert row.score == pytest.approx(expected, abs=1e-8)
        if rule:
            assert row.verdict == ("allow" if rule.allow else "block")
        else:
            steps.add((row.score, row.verdict))
    # One threshold parts those without a rule.
    assert max((s for s, v in steps if v == "block"), default=-9) < min((s for s, v in steps if v == "allow"), default=9)


def test_threshold_parts_best(spark):
    rows = [(-1.0, False, 3), (-0.505, False, 2), (0.1, True, 4), (0.3, False, 1), (0.4, True, 2)]
    scores = spark.createDataFrame(rows, "score double, allow boolean, pages long")
    found = urls._threshold(scores, urls.Settings())
    assert -0.505 < found <= 0.1 and found == 0.0
    assert urls._threshold(scores.filter("allow"), urls.Settings()) == 0.0
    far = spark.createDataFrame([(0.5, False, 1), (0.9, True, 1)], "score double, allow boolean, pages long")
    assert 0.5 < urls._threshold(far, urls.Settings()) <= 0.9


def test_judge_without_rules_or_rows(spark):
    df = spark.createDataFrame([(1, "http://a/"), (None, None)], "page_id long, url string")
    assert [(row.rule, row.verdict) for row in urls.judge(df, []).collect()] == [(None, "allow")] * 2
    assert urls.judge(df.limit(0), RULES).count() == 0


def test_urls_run_in_the_engine(spark):
    df = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    plan = urls.judge(df, RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

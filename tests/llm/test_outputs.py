"""Records, packing, shards."""

from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from clickloom.llm import packing, records, sharding, tokens

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCUMENTS = "doc_id long, text string, key string, ids string, part long, length string"


def documents(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(*row, "k", "i", 3, "l") for row in rows], DOCUMENTS)


@pytest.fixture(scope="module")
def rows():
    source = random.Random(4)
    words = ["alpha", "beta", "gamma,", "delta", "é", "\n"]
    made = [(n, " ".join(source.choices(words, k=source.choice([0, 1, 5, 60, 300])))) for n in range(60)]
    return [*made, (None, None), (None, "no key"), (7, "again"), (7, "again"), (61, None), (62, "long " * 3000)]


def plain_ids(text, end):
    encoder = tokens.encoder(TOKENIZER)
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_records_round_trip(spark, rows, tmp_path):
    manifest = records.write_tokens(documents(spark, rows).repartition(5), str(tmp_path), TOKENIZER, 2)
    found = records.read_tokens(spark, manifest).orderBy("start").collect()
    keys = [row.key for row in found]
    assert keys == sorted(keys, key=lambda key: (key is not None, key))
    expected = sorted(((key, plain_ids(text, 2)) for key, text in rows), key=str)
    assert sorted(((row.key, np.frombuffer(row.ids, "<u4").tolist()) for row in found), key=str) == expected
    start = 0
    for row in found:
        assert row.start == start and row.n_tokens == len(row.ids) // 4
        start += row.n_tokens
    # Any record can be read alone.
    path = manifest.orderBy("shard").first().path
    index = records.read_index(path)
    key, ids = records.read_record(path, len(index) - 1, index)
    last = [row for row in found if row.shard == 0][-1]
    assert (key, ids.tolist()) == (last.key, np.frombuffer(last.ids, "<u4").tolist())


def test_damaged_records_are_refused():
    data = b"".join(records.frame([b"first", b"", b"third" * 100]))
    assert records.unframe(data) == [b"first", b"", b"third" * 100]
    for place in (0, 9, 13, len(data) - 1):
        damaged = bytearray(data)
        damaged[place] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(damaged))
    with pytest.raises(ValueError):
        records.unframe(data[:-2])


def test_empty_tables(spark, tmp_path):
    empty = documents(spark, [])
    manifest = records.write_tokens(empty, str(tmp_path), TOKENIZER, 2)
    assert records.read_tokens(spark, manifest).count() == 0
    assert packing.pack(empty, TOKENIZER, 0, 64).count() == 0
    assert sharding.interleave(empty.select("doc_id", "text"), 4, source="text").count() == 0


def one_by_one(lengths, size):
    """Best fit decreasing, one piece after the other: the number of sequences."""
    rooms, count = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else size
        count += room == size
        if room > length:
            bisect.insort(rooms, room - length)
    return count


@pytest.mark.parametrize("seed", range(20))
def test_runs_are_best_fit_decreasing(seed):
    source = random.Random(seed)
    size = source.choice([7, 50, 200])
    lengths = [source.randint(1, source.choice([size, max(1, size // 3)])) for _ in range(source.choice([0, 1, 400]))]
    histogram = {length: lengths.count(length) for length in set(lengths)}
    runs = packing.best_fit_decreasing(histogram, size)
    used: dict[int, list[tuple[int, int]]] = {}
    for length, count in histogram.items():
        own = runs[runs[:, 0] == length]
        for rank in range(count):
            run = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            nth = rank - run[1]
            used.setdefault(int(run[3] + nth // run[2]), []).append((int(run[4] + nth % run[2] * length), length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(used) == one_by_one(lengths, size)


def test_pack(spark, rows):
    size = 64
    found = packing.pack(documents(spark, rows).repartition(6), TOKENIZER, 0, size).collect()
    expected = []
    for key, text in rows:
        ids = plain_ids(text, 0)
        first = len(ids) % size or min(size, len(ids))
        edges = [0, *range(first, len(ids) + 1, size)]
        expected += [(key, n, a, crc(ids[a:b])) for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    got = [(row.key, row.piece, row.start, zlib.crc32(row.ids)) for row in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    sequences: dict[int, list[tuple[int, int]]] = {}
    for row in found:
        assert row.length == len(row.ids) // 4
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) == one_by_one([row.length for row in found], size)


def test_interleave(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 40)
    source = random.Random(2)
    rows = [(n, "hot" if n % 3 else source.choice(["a", "b", None]), source.random()) for n in range(500)]
    rows += [(None, None, 1.0), (None, "hot", 1.0), (3, "hot", 2.0), (3, "hot", 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, r double").repartition(7)
    found = sharding.interleave(df, 8).collect()
    assert sorted(((row.doc_id, row.source, row.r) for row in found), key=str) == sorted(rows, key=str)
    by_shard: dict[int, list] = {}
    for row in found:
        by_shard.setdefault(row.shard, []).append(row)
    sizes = [len(own) for own in by_shard.values()]
    assert sorted(by_shard) == list(range(8)) and max(sizes) - min(sizes) <= 1
    for own in by_shard.values():
        assert sorted(row.slot for row in own) == list(range(len(own)))
    for name in {row[1] for row in rows}:
        shares = [sum(row.source == name for row in own) for own in by_shard.values()]
        assert max(shares) - min(shares) <= 2
    again = sharding.interleave(df.repartition(3), 8)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_more_shards_than_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    assert sorted(row.shard for row in sharding.interleave(df, 5).collect()) == [0, 1]
    clashing = df.withColumnRenamed("source", "slot").selectExpr("*", "1 AS rank", "2 AS row", "'x' AS shard", "3 AS bucket")
    found = sharding.interleave(clashing, 2, source="slot").orderBy("doc_id").collect()
    assert [(row.doc_id, row.rank, row.row, row.bucket, row.slot) for row in found] == [(1, 1, 2, 3, 0), (2, 1, 2, 3, 0)]


def test_columns_that_have_no_order(spark):
    values = ["map('b', doc_id, 'a', id) AS pairs", "array(map(doc_id, 'x')) AS nested", "parse_json(cast(doc_id AS string)) AS free"]
    df = spark.range(30).selectExpr("id % 3 AS doc_id", "'s' AS source", "id").selectExpr("doc_id", "source", *values)
    nulls = ["CAST(NULL AS map<string,bigint>) AS pairs", "CAST(NULL AS array<map<bigint,string>>) AS nested", "CAST(NULL AS variant) AS free"]
    df = df.unionByName(spark.range(2).selectExpr("id AS doc_id", "'s' AS source", *nulls))
    found = sharding.interleave(df, 4)
    assert found.columns == [*df.columns, "shard", "slot"]
    rows = found.selectExpr("doc_id", "to_json(pairs) AS pairs", "shard", "slot").collect()
    again = sharding.interleave(df.repartition(5), 4).selectExpr("doc_id", "to_json(pairs) AS pairs", "shard", "slot").collect()
    assert sorted(rows, key=str) == sorted(again, key=str)
    assert sorted((row.shard, row.slot) for row in rows) == [(shard, slot) for shard in range(4) for slot in range(8)]


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(n, "a") for n in range(10)], "doc_id long, source string")
    sharding.write_shards(sharding.interleave(df, 2), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().orderBy("shard").collect() == [(0, 5), (1, 5)]

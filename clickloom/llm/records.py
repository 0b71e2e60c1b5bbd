"""Token sequences as length-delimited binary records, with an offset index beside each file.

A record is framed as

    8 bytes  length of the data, little-endian
    4 bytes  masked CRC-32C of those 8 bytes
    data
    4 bytes  masked CRC-32C of the data

which is the framing that common training frameworks read. The data is a head of 10 bytes (key as a signed
64-bit number, 1 if there is a key, bytes of an id: 2 or 4) and the ids. ``shard-N.index`` holds one pair of
unsigned 64-bit numbers for each record of ``shard-N.records``: where it starts and how many ids it has, so
records can be read in any order without a scan. Shards ascend with the key: shard 0 has the smallest.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.batches import slices, text_bytes
from clickloom.llm.checksums import crc32c, masked
from clickloom.llm.shared import locate, whole_file
from clickloom.llm.tokens import SLICE, encoder

_HEAD = "<qBB"
_FRAME = 16
_READ_BYTES = 8 << 20

MANIFEST = "shard long, path string, records long, ids long"
RECORDS = "shard long, place long, key long, start long, n_tokens long, ids binary"


def frame(values: list[bytes]) -> list[bytes]:
    """Each value with its lengths and checksums."""
    sizes = [struct.pack("<Q", len(value)) for value in values]
    heads, tails = masked(crc32c(sizes)).astype("<u4"), masked(crc32c(values)).astype("<u4")
    return [
        b"".join((size, heads[n].tobytes(), value, tails[n].tobytes()))
        for n, (size, value) in enumerate(zip(sizes, values, strict=True))
    ]


def unframe(data: bytes) -> list[bytes]:
    """The values of whole records in a row; a wrong length or checksum raises ``ValueError``."""
    sizes, values, heads, tails, at = [], [], [], [], 0
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("a record breaks off")
        sizes.append(data[at : at + 8])
        length = int.from_bytes(sizes[-1], "little")
        if at + length + _FRAME > len(data):
            raise ValueError("a record breaks off or its length is damaged")
        heads.append(data[at + 8 : at + 12])
        values.append(data[at + 12 : at + 12 + length])
        tails.append(data[at + 12 + length : at + _FRAME + length])
        at += length + _FRAME
    for name, parts, kept in (("length", sizes, heads), ("data", values, tails)):
        if len(parts) and (masked(crc32c(parts)) != np.frombuffer(b"".join(kept), "<u4")).any():
            raise ValueError(f"the checksum of a record's {name} does not match")
    return values


def write_tokens(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode ``text`` and write one record for each row in ascending order of ``key``; the manifest of shards.

    Nulls: a null key comes first and stays null, a null text counts as empty and gives ``end_id`` alone.
    Rows of one key stand next to each other, ordered by text. Other columns play no part, so their names may
    clash. Long texts are encoded whole. An empty table gives an empty manifest.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # The hash splits rows that share a key over several shards.
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key", "tie")
    rows = rows.sortWithinPartitions("key", "tie", "text").select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        kind = np.dtype(f"<u{width}")
        path = f"{folder}/shard-{shard:08d}"
        entries, at = [], 0
        with whole_file(f"{path}.records") as out:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                data, offsets = text_bytes(batch.column(1))
                for first, last, part, places in slices(data, offsets, SLICE):
                    ids, starts = encode.encode(part, places)
                    values = []
                    for n in range(last - first):
                        own = keys[first + n]
                        head = struct.pack(_HEAD, 0 if own is None else own, own is not None, width)
                        ends = np.append(ids[starts[n] : starts[n + 1]], np.uint32(end_id))
                        values.append(head + ends.astype(kind).tobytes())
                        entries.append((at, len(ends)))
                        at += len(values[-1]) + _FRAME
                    out.write(b"".join(frame(values)))
        with whole_file(f"{path}.index") as out:
            out.write(np.array(entries, "<u8").tobytes())
        if entries:
            total = sum(count for _, count in entries)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [path], "records": [len(entries)], "ids": [total]}
            )

    return stages.written(rows.mapInArrow(write, MANIFEST), "records-manifest")[0]


def read_index(path: str) -> np.ndarray:
    """Start and number of ids of each record of a shard."""
    store, name = locate(f"{path}.index")
    with store.open_input_file(name) as source:
        return np.frombuffer(source.read(), "<u8").reshape(-1, 2).astype(np.int64)


def read_record(path: str, number: int, index: np.ndarray) -> tuple[int | None, np.ndarray]:
    """One record by its number in the index: key and ids. This is what a shuffled reader calls."""
    store, name = locate(f"{path}.records")
    with store.open_input_file(name) as source:
        end = int(index[number + 1, 0]) if number + 1 < len(index) else source.size()
        source.seek(int(index[number, 0]))
        return _parse(unframe(source.read(end - int(index[number, 0])))[0])


def _parse(value: bytes) -> tuple[int | None, np.ndarray]:
    key, known, width = struct.unpack_from(_HEAD, value)
    return key if known else None, np.frombuffer(value, f"<u{width}", offset=struct.calcsize(_HEAD))


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """All records of the manifest's shards, checked: shard, place, key, start, n_tokens, ids.

    ``start`` counts the ids of all records before; ``ids`` are little-endian unsigned 32-bit numbers.
    """
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, base in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                yield from _read_shard(shard, path, base)

    # One task for each shard: the manifest is a small table, the files are not.
    count = max(1, manifest.count())
    spread = shards.repartitionByRange(count, "shard")
    return spread.mapInArrow(read, RECORDS)


def _read_shard(shard: int, path: str, base: int) -> Iterator[pa.RecordBatch]:
    index = read_index(path)
    store, name = locate(f"{path}.records")
    with store.open_input_file(name) as source:
        ends = np.append(index[1:, 0], source.size())
        first = 0
        while first < len(index):
            begin = int(index[first, 0])
            last = max(first + 1, int(np.searchsorted(ends, begin + _READ_BYTES, "right")))
            source.seek(begin)
            parsed = [_parse(value) for value in unframe(source.read(int(ends[last - 1]) - begin))]
            counts = np.array([len(ids) for _, ids in parsed], np.int64)
            if len(parsed) != last - first or (counts != index[first:last, 1]).any():
                raise ValueError(f"the index of {path} does not match its records")
            starts = base + np.cumsum(counts) - counts
            base += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(parsed), shard)),
                    pa.array(np.arange(first, last)),
                    pa.array([key for key, _ in parsed], pa.int64()),
                    pa.array(starts),
                    pa.array(counts),
                    pa.array([ids.astype("<u4").tobytes() for _, ids in parsed], pa.binary()),
                ],
                names=["shard", "place", "key", "start", "n_tokens", "ids"],
            )
            first = last


def ids_crc32(ids: Column) -> Column:
    """The plain CRC-32 of the ids' bytes."""
    return F.crc32(ids)

"""Topics as logs of records in files: partitions, offsets, bounded batches, and progress by group.

A log is a folder ``path/topic/partition=p`` with segments ``<first>-<next>.parquet`` that appear in one step and
never change. Offsets are in the names, so the earliest and the next one of each partition are known without opening a file.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from clickloom.operators.saved import store_of

FORMAT, OFFSETS_FORMAT = "record_log", "record_log_offsets"
RECORDS = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
OFFSETS = "topic string, partition int, earliest long, latest long, messages long"
_STORED = pa.schema([("timestamp", pa.timestamp("us", "UTC")), ("key", pa.string()), ("value", pa.string())])
_SEGMENT = re.compile(r"(?:^|/)([^/]+)/partition=(\d+)/(\d+)-(\d+)\.parquet$")
_MARK = re.compile(r"(?:^|/)([^/]+)/partition=(\d+)/created$")
_ROWS = 10_000


@dataclass(frozen=True)
class Segment:
    file: str
    first: int
    next: int


@dataclass
class Piece(InputPartition):
    """Offsets ``first`` to ``next`` of one segment."""

    path: str
    file: str
    topic: str
    partition: int
    base: int
    first: int
    next: int


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[int, str, int]]  # partition, file, rows


class Log:
    """What the files of a log say."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.store, self.root = store_of(path)

    def segments(self, topics: Sequence[str] | None = None) -> dict[tuple[str, int], list[Segment]]:
        """The segments of every partition that was created, in order."""
        found: dict[tuple[str, int], list[Segment]] = {}
        for info in self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            if mark := _MARK.search(info.path):
                found.setdefault((mark[1], int(mark[2])), [])
            elif name := _SEGMENT.search(info.path):
                found.setdefault((name[1], int(name[2])), []).append(Segment(info.path, int(name[3]), int(name[4])))
        kept = {key: sorted(own, key=lambda s: s.first) for key, own in sorted(found.items()) if topics is None or key[0] in topics}
        return kept

    def put(self, file: str, data: bytes) -> None:
        """A small file that appears in one step."""
        self.store.create_dir(file.rpartition("/")[0], recursive=True)
        attempt = f"{file}.{uuid.uuid4().hex}.tmp"
        with self.store.open_output_stream(attempt) as out:
            out.write(data)
        self.store.move(attempt, file)

    def group_file(self, group: str) -> str:
        return f"{self.root}/_groups/{group}.json"

    def position(self, group: str) -> dict[str, int] | None:
        """How far a group has planned to read."""
        info = self.store.get_file_info(self.group_file(group))
        if info.type != fs.FileType.File:
            return None
        with self.store.open_input_stream(info.path) as source:
            return json.loads(source.read())


def _ends(segments: dict[tuple[str, int], list[Segment]]) -> dict[str, tuple[int, int]]:
    """Earliest and next offset by ``topic/partition``."""
    return {f"{topic}/{p}": (own[0].first, own[-1].next) if own else (0, 0) for (topic, p), own in segments.items()}


def _pieces(path: str, segments: dict[tuple[str, int], list[Segment]], start: dict[str, int], end: dict[str, int]) -> list[Piece]:
    """What lies between two positions. A partition that ``start`` does not know is read from its beginning."""
    pieces = []
    for (topic, p), own in segments.items():
        name = f"{topic}/{p}"
        low, high = start.get(name, 0), end.get(name, 0)
        for s in own:
            first, last = max(low, s.first), min(high, s.next)
            if first < last:
                pieces.append(Piece(path, s.file, topic, p, s.first, first, last))
    return pieces


def _read(piece: Piece) -> Iterator[pa.RecordBatch]:
    store, _ = store_of(piece.path)
    with store.open_input_file(piece.file) as source:
        at = piece.base
        for batch in pq.ParquetFile(source).iter_batches(_ROWS):
            low, high = max(piece.first - at, 0), min(piece.next - at, batch.num_rows)
            if low < high:
                rows = batch.slice(low, high - low)
                n = rows.num_rows
                fixed = [pa.array([piece.topic] * n), pa.array([piece.partition] * n, pa.int32()), pa.array(range(at + low, at + high), pa.int64())]
                names = ["topic", "partition", "offset", *_STORED.names]
                yield pa.RecordBatch.from_arrays([*fixed, *(rows.column(rows.schema.names.index(c)) for c in _STORED.names)], names=names)
            at += batch.num_rows


def bounded(start: dict[str, int], ends: dict[str, int], limit: int) -> dict[str, int]:
    """At most ``limit`` offsets on from ``start``, shared out by how far each partition is behind."""
    behind = {name: end - start.get(name, 0) for name, end in ends.items()}
    total = sum(behind.values())
    if total <= limit:
        return dict(ends)
    steps = {name: limit * n // total for name, n in behind.items()}
    for name in sorted(behind, key=lambda name: (-(limit * behind[name] % total), name))[: limit - sum(steps.values())]:
        steps[name] += 1
    return {name: start.get(name, 0) + steps[name] for name in ends}


class RecordLog(DataSource):
    """Records of topics. Options: ``path``, ``subscribe`` (topics, separated by commas); for streams
    ``maxOffsetsPerTrigger`` and ``group``, whose progress bounds the first batch after a restart; for writing ``topic``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def _topics(self) -> list[str]:
        return [name.strip() for name in self.options["subscribe"].split(",")]

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options["path"], self._topics())

    def streamReader(self, schema) -> DataSourceStreamReader:
        limit = self.options.get("maxoffsetspertrigger") or self.options.get("maxOffsetsPerTrigger")
        return _StreamReader(self.options["path"], self._topics(), int(limit) if limit else None, self.options.get("group", "default"))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a log can only be appended to")
        return _Writer(self.options["path"], self.options["topic"])


class _BatchReader(DataSourceReader):
    """From the earliest offsets to those that are latest when the read is planned."""

    def __init__(self, path: str, topics: list[str]) -> None:
        self.path, self.topics = path, topics

    def partitions(self) -> Sequence[InputPartition]:
        segments = Log(self.path).segments(self.topics)
        unknown = set(self.topics) - {topic for topic, _ in segments}
        if unknown:
            raise ValueError(f"no such topic: {', '.join(sorted(unknown))}")
        return _pieces(self.path, segments, {}, {name: end for name, (_, end) in _ends(segments).items()})

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Piece):
            yield from _read(partition)


class _StreamReader(DataSourceStreamReader):
    """Positions are ``{"topic/partition": offset}``. What was planned last is also kept with the log, by group."""

    def __init__(self, path: str, topics: list[str], limit: int | None, group: str) -> None:
        self.path, self.topics, self.limit, self.group = path, topics, limit, group
        self.last: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        self.last = {name: first for name, (first, _) in _ends(Log(self.path).segments(self.topics)).items()}
        return self.last

    def latestOffset(self) -> dict:
        log = Log(self.path)
        ends = {name: end for name, (_, end) in _ends(log.segments(self.topics)).items()}
        if self.limit is None:
            return ends
        if self.last is None:
            self.last = log.position(self.group) or {}
        return bounded(self.last, ends, self.limit)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        log = Log(self.path)
        self.last = dict(end)
        if self.limit is not None:
            log.put(log.group_file(self.group), json.dumps(end).encode())
        return _pieces(self.path, log.segments(self.topics), start, end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from _read(partition)

    def commit(self, end: dict) -> None:
        pass


class _Writer(DataSourceArrowWriter):
    """Tasks write whole files; the offsets are given out when all of them are there."""

    def __init__(self, path: str, topic: str) -> None:
        self.path, self.topic = path, topic

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        log = Log(self.path)
        count = max((p for topic, p in log.segments([self.topic])), default=-1) + 1
        if not count:
            raise ValueError(f"no such topic: {self.topic}")
        open_files: dict[int, tuple[str, pq.ParquetWriter, object]] = {}
        rows: dict[int, int] = {}
        for batch in iterator:
            names = batch.schema.names
            numbers = batch.column(names.index("partition")) if "partition" in names else pa.array([0] * batch.num_rows)
            now = pa.array([datetime.now(timezone.utc)] * batch.num_rows, _STORED.field("timestamp").type)
            given = {"timestamp": now, "key": pa.nulls(batch.num_rows, pa.string())}
            columns = [batch.column(names.index(c)).cast(_STORED.field(c).type) if c in names else given[c] for c in _STORED.names]
            table = pa.table(columns, schema=_STORED)
            of = numbers.to_numpy(zero_copy_only=False) % count
            for p in sorted(set(of.tolist())):
                if p not in open_files:
                    file = f"{log.root}/{self.topic}/partition={p}/.{uuid.uuid4().hex}.part"
                    sink = log.store.open_output_stream(file)
                    open_files[p] = (file, pq.ParquetWriter(sink, _STORED), sink)
                own = table.filter(pa.array(of == p))
                open_files[p][1].write_table(own)
                rows[p] = rows.get(p, 0) + own.num_rows
        for _, writer, sink in open_files.values():
            writer.close()
            sink.close()
        return _Written([(p, file, rows[p]) for p, (file, _, _) in sorted(open_files.items())])

    def commit(self, messages) -> None:
        log = Log(self.path)
        ends = {p: own[-1].next if own else 0 for (_, p), own in log.segments([self.topic]).items()}
        for message in messages:
            for p, file, count in message.files if message else []:
                first, ends[p] = ends[p], ends[p] + count
                log.store.move(file, f"{log.root}/{self.topic}/partition={p}/{first:020d}-{ends[p]:020d}.parquet")

    def abort(self, messages) -> None:
        store = Log(self.path).store
        for message in messages:
            for _, file, _ in message.files if message else []:
                store.delete_file(file)


class RecordLogOffsets(DataSource):
    """Earliest and next offset of each partition of all topics below ``path``, from the names of the files."""

    @classmethod
    def name(cls) -> str:
        return OFFSETS_FORMAT

    def schema(self) -> str:
        return OFFSETS

    def reader(self, schema) -> DataSourceReader:
        return _OffsetsReader(self.options["path"])


class _OffsetsReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for name, (first, end) in _ends(Log(self.path).segments()).items():
            topic, _, p = name.rpartition("/")
            yield topic, int(p), first, end, end - first


def register(spark: SparkSession) -> None:
    """Make both formats known to the session."""
    for source in (RecordLog, RecordLogOffsets):
        spark.dataSource.register(source)


def create_topic(path: str, topic: str, partitions: int) -> None:
    """A topic without records. Partitions that are there stay as they are."""
    log = Log(path)
    for p in range(partitions):
        log.put(f"{log.root}/{topic}/partition={p}/created", b"")


def log_options(path: str, topics: Sequence[str], limit: int | None = None, group: str = "default") -> dict[str, str]:
    """Options for reading topics, in batch or as a stream."""
    options = {"path": path, "subscribe": ",".join(topics), "group": group}
    return options if limit is None else options | {"maxOffsetsPerTrigger": str(limit)}


def append(df: DataFrame, path: str, topic: str) -> None:
    """Append ``value`` (and ``key``, ``timestamp``, ``partition``, where there are such columns) to a topic."""
    register(df.sparkSession)
    kinds = {"partition": "int", "timestamp": "timestamp", "key": "string", "value": "string"}
    columns = [F.col(name).cast(kind) for name, kind in kinds.items() if name in df.columns]
    df.select(*columns).write.format(FORMAT).mode("append").options(path=path, topic=topic).save()


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """``topic, partition, earliest, latest, messages`` of every partition, those without records too."""
    register(spark)
    return spark.read.format(OFFSETS_FORMAT).option("path", path).load()


def count_messages(partitions: DataFrame, topic: str) -> DataFrame:
    """One row: the messages of a topic; 0 if it is empty, -1 if there is no such topic."""
    own = partitions.filter(F.col("topic") == topic)
    return own.agg(F.coalesce(F.sum("messages"), F.lit(-1)).cast("long").alias("messages"))

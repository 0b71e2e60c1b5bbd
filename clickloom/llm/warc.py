"""WARC archives: a writer, and a reader whose tasks each scan a byte range of a file.

Every record is a gzip member of its own, so a reader may start at any member. A task gets a byte range,
scans it for the gzip magic and tries each place: it has found a record if the member decodes to a WARC
version line and header fields, ends with a right checksum, and another member or the end of the file comes
next. From then on members follow each other. A task owns the records that start inside its range and reads
the last one beyond the range's end, so each record is read once, whatever the ranges.

A payload that itself holds a stored, uncompressed run of whole compressed archives could pass for records
of the file; text cannot, because the magic is not valid UTF-8.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import stages
from clickloom.llm.shared import locate, whole_file

LEAST_REVISIT = 1000
SPLIT_BYTES = 32 << 20
MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 20
_HEAD_LIMIT = 1 << 16
_DATE = "1970-01-01T00:00:00Z"
_BATCH = 500

MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _member(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member; fields without a value are left out."""
    lines = [f"{name}: {_one_line(value)}" for name, value in fields if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode()
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + press.flush()


def _one_line(value: str) -> str:
    """A header value must not hold line breaks; they and the percent sign are escaped."""
    if not any(mark in value for mark in "\r\n%"):
        return value
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _as_was(value: str | None, escaped: bool) -> str | None:
    if value is None or not escaped:
        return value
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def mark_revisits(df: DataFrame, key: str, url: str, payload: str, least: int = LEAST_REVISIT) -> DataFrame:
    """key, url, payload, length, sha1 and ``original``: the key that a revisit refers to, null for responses.

    Of equal payloads of at least ``least`` bytes the one with the largest key is the response. Payloads are
    told apart by SHA-1, length and a second hash. Rows that share that largest key are responses all. The
    table of copied payloads holds digests only; where it is too large to be broadcast, all rows are shuffled
    by digest with their payloads.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns(
        {"length": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "other": F.xxhash64("payload")}
    )
    same = ["sha1", "length", "other"]
    groups = rows.filter(F.col("length") >= least).groupBy(*same).agg(F.max("key").alias("top"), F.count(F.lit(1)).alias("n"))
    copied = groups.filter("n > 1").drop("n")
    original = F.when(F.col("key").isNull() | (F.col("key") < F.col("top")), F.col("top")).alias("original")
    return rows.join(copied, same, "left").select("key", "url", "payload", "length", "sha1", original)


def write_warc(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """Write one response or revisit record for each row; the manifest of files.

    The record id is ``<urn:row:KEY>``. Nulls: a null payload is empty, a null URL leaves the target out, a
    null key gives an id without a key (``<urn:row:>``) and loses against any key. Line breaks in a URL are
    escaped. Repeated rows are written as often as they come. Payloads are written whole. An empty table
    gives an empty manifest. Other columns play no part.
    """
    rows = mark_revisits(df, key, url, payload, least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{TaskContext.get().partitionId():08d}.warc.gz"
        size = count = 0
        out = None
        with _lazily(path) as opened:
            for batch in batches:
                if not batch.num_rows:
                    continue
                out = out or opened()
                if not size:
                    name = uuid.uuid5(uuid.NAMESPACE_URL, path)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", _DATE)]
                    size += out.write(_member(info, b"software: clickloom\r\nformat: WARC File Format 1.1\r\n"))
                for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    size += out.write(_page(*row))
                    count += 1
        if count:
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    return stages.written(rows.mapInArrow(write, MANIFEST), "warc-manifest")[0]


class _lazily:
    """A file that comes into being with the first record."""

    def __init__(self, path: str) -> None:
        self.path, self.file = path, None

    def __enter__(self):
        def opened():
            self.file = whole_file(self.path)
            return self.file.__enter__()

        return opened

    def __exit__(self, *error) -> None:
        if self.file is not None:
            self.file.__exit__(*error)


def _page(key: int | None, url: str | None, payload: bytes, length: int, sha1: str, original: int | None) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", _row_id(key)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", url),
        ("X-Escaped", "yes" if url is not None and _one_line(url) != url else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if original is None:
        return _member(fields, _http(length) + payload)
    fields.append(("WARC-Refers-To", _row_id(original)))
    fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    return _member(fields, _http(length))


def _row_id(key: int | None) -> str:
    return f"<urn:row:{'' if key is None else key}>"


class _Window:
    """A file read forward in chunks, of which the part that is still needed is kept."""

    def __init__(self, path: str, start: int) -> None:
        store, name = locate(path)
        self.file = store.open_input_file(name)
        self.size = self.file.size()
        self.base, self.data = start, b""

    def upto(self, end: int) -> None:
        """Have everything before ``end``, as far as the file goes."""
        missing = min(end, self.size) - self.base - len(self.data)
        if missing > 0:
            self.file.seek(self.base + len(self.data))
            self.data += self.file.read(max(missing, _CHUNK))

    def forget(self, before: int) -> None:
        self.data, self.base = self.data[before - self.base :], before

    def at(self, place: int, count: int) -> bytes:
        self.upto(place + count)
        return self.data[place - self.base : place - self.base + count]


def _decode(window: _Window, place: int) -> tuple[bytes, int] | None:
    """The content of the member at ``place`` and where it ends, or ``None`` if there is no WARC record."""
    if window.at(place, 3) != MAGIC:
        return None
    press, parts, at, checked = zlib.decompressobj(31), [], place, False
    try:
        while not press.eof:
            chunk = window.at(at, _CHUNK)
            if not chunk:
                return None
            parts.append(press.decompress(chunk))
            at += len(chunk)
            if not checked and sum(map(len, parts)) >= 16:
                # Most false places end here, after a few bytes.
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    content = b"".join(parts)
    return (content, at - len(press.unused_data)) if content.startswith(b"WARC/1.") else None


def _fields(content: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields by lower-case name, and where the block starts; ``None`` if the head is damaged."""
    end = content.find(b"\r\n\r\n", 0, _HEAD_LIMIT)
    if end < 0:
        end = content.find(b"\r\n\r\n")
    if end < 0:
        return None
    result = {}
    for line in content[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        result[name.strip().lower()] = value.strip()
    if not result.get("content-length", "").isdigit() or "warc-type" not in result:
        return None
    return result, end + 4


def scan(path: str, start: int, end: int, damage: list[int] | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of the records that start in a byte range.

    Where a record has to begin and none does, its offset is added to ``damage``, and the search goes on. The
    task that read the record before adds it, even beyond its range, so each is added once.
    """
    window, place, sure = _Window(path, start), start, start == 0
    damage = [] if damage is None else damage
    while place < min(end, window.size):
        if not sure:
            window.upto(min(place + _CHUNK, end + 2))
            found = window.data.find(MAGIC, place - window.base)
            if found < 0:
                # The magic may reach over the edge of what has been read.
                place = max(place, window.base + len(window.data) - 2)
                window.forget(place)
                if place >= min(end, window.size) - 2:
                    more = window.at(place, 4)
                    hit = more.find(MAGIC)
                    if hit < 0 or place + hit >= end:
                        return
                    place += hit
                else:
                    continue
            else:
                place = window.base + found
            if place >= end:
                return
        window.forget(place)
        found = _found(window, place)
        if found is None:
            if sure:
                damage.append(place)
            place, sure = place + 1, False
            continue
        fields, block, after = found
        yield place, fields, block
        place, sure = after, True
    if sure and end <= place < window.size:
        window.forget(place)
        if _found(window, place) is None:
            # The next task cannot know that a record has to begin here.
            damage.append(place)


def _found(window: _Window, place: int) -> tuple[dict[str, str], bytes, int] | None:
    """Fields and block of the record at a place, and where it ends: at another member or the end of the file."""
    decoded = _decode(window, place)
    head = _fields(decoded[0]) if decoded else None
    if head is None or window.at(decoded[1], 3) not in (b"", MAGIC):
        return None
    (content, after), (fields, block) = decoded, head
    return fields, content[block : block + int(fields["content-length"])], after


def _record(path: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    payload = digest = length = None
    named = fields.get("warc-payload-digest", "")
    if named.startswith("sha1:"):
        digest = base64.b32decode(named[5:]).hex()
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            payload, length = body, len(body)
            if digest is not None and hashlib.sha1(body).hexdigest() != digest:
                raise ValueError(f"the payload at {offset} of {path} does not match its digest")
        else:
            for line in head.split(b"\r\n"):
                if line.lower().startswith(b"content-length:"):
                    length = int(line.split(b":")[1])
    escaped = "x-escaped" in fields
    target = _as_was(fields.get("warc-target-uri"), escaped)
    return (path, offset, fields.get("warc-record-id"), kind, target, fields.get("warc-refers-to"), length, digest, payload)


def read_warc(
    spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True, damaged: str = "raise"
) -> DataFrame:
    """All records of the ``.warc.gz`` files of a folder, one task for each byte range of ``split_bytes``.

    Columns: path, offset, record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest (hex
    SHA-1; checked for responses), payload (null for other records, and unless ``payloads``).

    Damaged members, and bytes that belong to none, fail the job with their path and offset. With
    ``damaged="report"`` each such stretch is a row of the type ``damaged`` with the offset where it begins,
    and the records after it are read; a record that no member follows belongs to the stretch, because it
    cannot be told from one inside a payload. Empty files have no records.
    """
    # The listing runs on Spark; only the length column of the files is read.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    return read_ranges(files, split_bytes, payloads, damaged)


def read_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True, damaged: str = "raise") -> DataFrame:
    """:func:`read_warc` for a table of files: path, length."""
    if damaged not in ("raise", "report"):
        raise ValueError(f"damaged members can be raised or reported, not {damaged}")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.filter("length > 0").select("path", starts.alias("start"), "length")
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, F.col("length"))).drop("length")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        for batch in batches:
            for path, start, end in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                rows, damage = [], []
                for offset, fields, block in scan(path, start, end, damage):
                    rows.append(_record(path, offset, fields, block))
                    if not payloads:
                        rows[-1] = (*rows[-1][:-1], None)
                    if len(rows) == _BATCH:
                        yield _batch(names, rows)
                        rows = []
                if damage and damaged == "raise":
                    raise ValueError(f"no record can be read at {damage[0]} of {path}")
                rows += [(path, offset, None, "damaged", *[None] * 5) for offset in damage]
                if rows:
                    yield _batch(names, rows)

    # One task for each range, however little its description weighs.
    count = max(1, ranges.count())
    return ranges.repartition(count, "path", "start").mapInArrow(read, RECORDS)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)

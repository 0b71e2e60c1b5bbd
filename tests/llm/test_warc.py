"""WARC archives, written and read by byte ranges."""

from __future__ import annotations

import hashlib
import random

import pytest

from clickloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], "page_id long, url string, html string, key string, length string")


@pytest.fixture(scope="module")
def rows():
    source = random.Random(5)
    big = "é" * 600
    noise = ["".join(chr(source.randint(1, 0x2FF)) for _ in range(source.randint(0, 4000))) for _ in range(40)]
    made = [(n, f"http://h/{n}", text) for n, text in enumerate(noise)]
    copies = [(n, "u", big) for n in (100, 103, 101)] + [(n, "u", "small") for n in (110, 111)]
    odd = [(None, None, None), (120, None, ""), (121, "a\r\nb%0A", "x\r\n\r\ny"), (None, "u", big), (103, "u", big), (122, "u", "a" * 999 + "b")]
    return [*made, *copies, *odd, (123, "u", "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 200)]


def expected(rows):
    largest: dict[bytes, int] = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and key is not None:
            largest[body] = max(largest.get(body, key), key)
    out = []
    for key, url, html in rows:
        body = (html or "").encode()
        top = largest.get(body)
        revisit = top is not None and (key is None or key < top)
        out.append(
            (
                f"<urn:row:{'' if key is None else key}>",
                url,
                len(body),
                hashlib.sha1(body).hexdigest(),
                "revisit" if revisit else "response",
                f"<urn:row:{top}>" if revisit else None,
                None if revisit else body,
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64, 1000, 1 << 25])
def test_round_trip(spark, rows, tmp_path, split):
    folder = str(tmp_path / "warc")
    manifest = warc.write_warc(pages(spark, rows).repartition(3), folder)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    found = [row for row in warc.read_warc(spark, folder, split).collect() if row.record_type != "warcinfo"]
    names = ("record_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    got = [tuple(bytes(row[name]) if isinstance(row[name], bytearray) else row[name] for name in names) for row in found]
    assert sorted(got, key=str) == expected(rows)
    assert len({(row.path, row.offset) for row in found}) == len(rows)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "warc")
    (tmp_path / "warc").mkdir()
    assert warc.write_warc(pages(spark, []), folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_damaged_member_is_skipped(tmp_path):
    first = warc._page(1, "u", b"one", 3, hashlib.sha1(b"one").hexdigest(), None)
    second = warc._page(2, "u", b"two", 3, hashlib.sha1(b"two").hexdigest(), None)
    path = tmp_path / "a.warc.gz"
    damaged = bytearray(first)
    damaged[20] ^= 0xFF
    path.write_bytes(bytes(damaged) + second)
    found = [fields["warc-record-id"] for _, fields, _ in warc.scan(str(path), 0, path.stat().st_size)]
    assert found == ["<urn:row:2>"]


def test_wrong_digest_is_refused():
    fields = {"warc-type": "response", "warc-payload-digest": "sha1:" + "A" * 32}
    with pytest.raises(ValueError):
        warc._record("p", 0, fields, b"HTTP/1.1 200 OK\r\n\r\nbody")


def test_damage_is_told_once_whatever_the_ranges(spark, tmp_path):
    members = [warc._page(n, "u", body, len(body), hashlib.sha1(body).hexdigest(), None) for n, body in enumerate([b"one", b"two" * 50, b"three", b"four", b"five"])]
    starts = [sum(map(len, members[:n])) for n in range(6)]
    path = tmp_path / "a.warc.gz"
    for broken, extra in (({1}, b""), ({0}, b""), ({1, 2}, b""), ({4}, b""), (set(), b"junk"), ({3}, b"junk"), (set(), b"")):
        data = bytearray(b"".join(members))
        for n in broken:
            data[starts[n] + 20] ^= 0xFF
        path.write_bytes(bytes(data) + extra)
        size = path.stat().st_size
        # A record that junk follows belongs to the stretch; neighbours are one stretch, told where it begins.
        lost = broken | ({4} if extra else set())
        told = [starts[n] for n in sorted(lost) if n - 1 not in lost]
        for split in (7, 50, 64, 200, 1 << 20):
            damage: list[int] = []
            found = [place for low in range(0, size, split) for place, _, _ in warc.scan(str(path), low, min(low + split, size), damage)]
            assert found == [starts[n] for n in range(5) if n not in lost], (broken, extra, split)
            assert sorted(damage) == told, (broken, extra, split)
    data = bytearray(b"".join(members))
    path.write_bytes(bytes(data[: starts[4] + 30]))
    with pytest.raises(Exception, match="no record can be read"):
        warc.read_warc(spark, str(tmp_path)).collect()
    rows = warc.read_warc(spark, str(tmp_path), 64, damaged="report").collect()
    assert sorted((row.record_type, row.offset) for row in rows) == sorted([*(("response", n) for n in starts[:4]), ("damaged", starts[4])])
    with pytest.raises(ValueError):
        warc.read_warc(spark, str(tmp_path), damaged="skip")


def test_a_long_record_is_read_over_many_ranges(spark, tmp_path):
    source = random.Random(2)
    long = "".join(chr(source.randint(32, 0x24F)) for _ in range(3_000_000))
    folder = str(tmp_path / "warc")
    warc.write_warc(pages(spark, [(1, "u", "a"), (2, "u", long), (3, "u", "b")]).coalesce(1), folder)
    found = warc.read_warc(spark, folder, 300_000).filter("record_type = 'response'").orderBy("record_id").collect()
    assert [bytes(row.payload).decode() for row in found] == ["a", long, "b"]

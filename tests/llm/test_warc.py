"""WARC archives: round trip, broken archives, and the contract against plain Python."""

import hashlib
import struct

import pytest
import zstandard

from tidemark.llm import warc
from tests.llm.helpers import clashing, frame

SCHEMA = "page_id bigint, url string, html string"
BIG = "<p>" + "x" * 1200 + "é</p>"


def expected(rows):
    body = [(i, (h or "").encode()) for i, _, h in rows]
    groups = {}
    for i, b in body:
        if len(b) >= 1000:
            groups.setdefault(b, []).append(i)
    out = []
    for i, b in body:
        ids = groups.get(b, [])
        known = [k for k in ids if k is not None]
        last = max(known) if len(ids) > 1 and known else None
        revisit = last is not None and i != last
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


def rows():
    out = [(1, "http://a/", BIG), (2, "http://a/", BIG), (5, None, BIG), (5, None, BIG), (None, "http://n/", BIG), (3, "http://b/", None), (4, "http://b/", ""), (6, "u\r\nX: y", "short"), (7, "u", "short"),
           (8, "u", "z" * 1000), (9, "u", "z" * 1000), (10, "u", "z" * 999), (11, "u", "z" * 999), (-4, "ü", "\r\n\r\nWARC/1.1\r\n\x00" * 200), (12, "long", "abc é" * 700_000)]
    return out + [(100 + k, f"http://h{k % 3}/{k}", f"<html><body><nav>menu</nav><p>{'word ' * (k * 9)}</p></body></html>") for k in range(40)]


def test_round_trip_equals_plain_python(spark):
    df = clashing(frame(spark, rows(), SCHEMA).repartition(3), "payload", "size", "payload_key", "last_id", "revisit", "archive")
    got = warc.digest(warc.through_archives(df, volume_bytes=2000))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows())


def test_empty_table_and_text_ids(spark):
    assert warc.through_archives(frame(spark, [], SCHEMA)).count() == 0
    ids = [("a b", "u", BIG), ("ü%41\n", "u", BIG), (None, "u", BIG), ("", "u", "x")]
    got = warc.digest(warc.through_archives(frame(spark, ids, SCHEMA.replace("bigint", "string"))))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ids)


def test_payloads_and_targets_come_back(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archives(frame(spark, rows(), SCHEMA).coalesce(1), path, volume_bytes=500)
    got = {(r.page_id, r.record_type): r for r in warc.read_archives(spark, path).collect()}
    for i, url, html in rows():
        r = got.get((None if i is None else str(i), "response"))
        if r is not None:
            assert bytes(r.payload) == (html or "").encode()
            assert r.target_uri == (None if url is None else warc._clean(url))
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(files) > 1
    for p in files:  # each archive begins with its own dictionary and can be read by itself
        data = p.read_bytes()
        assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY
        assert all(warc.parse_record(d) for d in warc.read_frames(data))


def record(**change):
    data = warc.build_record("1", "http://a/", b"payload", None, False, "2020-01-01T00:00:00Z")
    for old, new in change.get("swap", []):
        assert old in data
        data = data.replace(old, new)
    return data


@pytest.mark.parametrize(
    "swap",
    [[(b"WARC/1.1", b"WARC/9.1")], [(b"WARC-Date: ", b"X-Date: ")], [(b"payload\r\n\r\n", b"payload")], [(b"payload\r\n\r\n", b"payloaX\r\n\r\n")],
     [(b"payload\r\n\r\n", b"payloads\r\n\r\n")], [(b"Content-Length: 7", b"Content-Length: 8")], [(b"Content-Length: 7", b"Content-Length: x")], [(b"sha1:", b"md5:")], [(b"WARC-Date: ", b"WARC-Type: ")],
     [(b"HTTP/1.1 200", b"XTTP/1.1 200")], [(b"WARC-Type: response", b"WARC-Type: revisit")]],
)
def test_broken_records_are_errors(swap):
    assert warc.parse_record(record())["payload"] == b"payload"
    with pytest.raises(warc.WarcError):
        warc.parse_record(record(swap=swap))


def test_broken_archives_are_errors():
    press = zstandard.ZstdCompressor(write_checksum=True)
    one, two = press.compress(record()), press.compress(b"second " * 50_000)
    skip = warc.SEPARATOR.encode()
    assert list(warc.read_frames(one + skip + two)) == [record(), b"second " * 50_000]
    assert list(warc.read_frames(b"")) == []
    raw = bytearray(one)
    raw[-1] ^= 255  # the checksum
    dictionary = struct.pack("<II", warc.DICTIONARY, 3) + b"abc"
    for bad in (one[:-1], one + b"xy", one + b"not a frame", bytes(raw), one + dictionary, skip[:-1], skip[:4] + b"\x09\0\0\0"):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(bad))


def test_foreign_archives_without_sizes_or_dictionary():
    press = zstandard.ZstdCompressor(write_content_size=False)
    data = record() * 1
    obj = press.compressobj()
    frame_bytes = obj.compress(data) + obj.flush()
    assert list(warc.read_frames(frame_bytes)) == [data]
    plain = b"WARC/1.1 200 OK header " * 40
    for body in (plain, zstandard.ZstdCompressor().compress(plain)):
        trained = zstandard.ZstdCompressionDict(plain)
        frame_bytes = zstandard.ZstdCompressor(dict_data=trained).compress(data)
        assert list(warc.read_frames(struct.pack("<II", warc.DICTIONARY, len(body)) + body + frame_bytes)) == [data]

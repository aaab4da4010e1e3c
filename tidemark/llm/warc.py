"""WARC archives compressed record by record with Zstandard and a shared dictionary.

Layout of an archive: a skippable frame (magic ``0x184D2A5D``) that holds the
dictionary, then one Zstandard frame for each record.  A frame's end is found by
walking its block headers, so the reader decodes one record at a time and never
looks for a marker.

Writing.  Of records with equal payloads of ``least`` bytes or more, the one with the
largest id is a ``response``, the others are ``revisit`` records without a payload that
name it.  Payloads are compared by length and SHA-256.  Spark's text writer puts the
archives on any store it reaches, with its commit protocol, so a lost executor leaves no
half archive: each output row is a whole archive of about ``volume_bytes``, and the line
separator that the writer adds is itself an empty skippable frame, which readers pass
over.  The dictionary is trained on a bounded sample (``sample_pages`` pages of at most
``sample_chars`` characters) and only serves compression.

Reading.  Archives come through Spark's binary file reader, one bounded archive a row.
The dictionary (plain or compressed) is loaded from the leading frame, then each frame is
decoded by itself and checked: frame size and checksum, WARC version line and mandatory
headers, ``Content-Length`` against the block, the closing empty lines, the HTTP
``Content-Length`` against the payload, and the payload's SHA-1 against its header.

Scale: the payloads are read once by the tasks that write them.  Only (digest, largest
id) of payloads that occur twice or more is staged; the planner broadcasts it under its
own size limit or joins by a shuffle, which AQE splits where a digest is hot.

Defined results: a null html is an empty payload; empty payloads and those under ``least``
bytes are all responses; repeated rows with the largest id are each a response; a null id
is least and stays null; a null url is a record without a target; an empty table gives no
archive and no record; control characters of a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.session import ensure_checkpoint_dir, track_staged

LEAST_BYTES = 1000
VOLUME_BYTES = 16_000_000
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 300, 16_384, 65_536
LEVEL = 6
# Frame magics of Zstandard, and the skippable one that holds a dictionary.
FRAME, DICTIONARY, SKIPPABLE_FIRST, SKIPPABLE_LAST = 0xFD2FB528, 0x184D2A5D, 0x184D2A50, 0x184D2A5F
#: An empty skippable frame, in ASCII: what Spark's text writer puts after each row.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:tidemark:page"


class WarcError(ValueError):
    """An archive or record that breaks its format."""


# ---- one record -------------------------------------------------------------


def _urn(page_id: str | None) -> str:
    if page_id is None:
        return f"<{URN}>"
    return f"<{URN}:{''.join(c if c.isascii() and (c.isalnum() or c in '._-') else ''.join(f'%{b:02X}' for b in c.encode('utf-8', 'surrogatepass')) for c in page_id)}>"


def _page_id(record_id: str) -> str | None:
    """The id inside a record's name; a foreign name is its own id."""
    name = record_id.removeprefix("<").removesuffix(">")
    if name == URN:
        return None
    if not name.startswith(URN + ":"):
        return name
    raw = re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m.group(1), 16)]), name[len(URN) + 1 :].encode())
    return raw.decode("utf-8", "surrogatepass")


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def build_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool, date: str) -> bytes:
    """A response, or a revisit of ``refers_to`` that carries the HTTP headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, what: str) -> tuple[str, dict[str, str], int]:
    """First line, headers by lower-case name, and where the block begins."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError(f"{what}: headers don't end")
    first, *lines = data[:end].decode("utf-8", "surrogatepass").split("\r\n")
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"{what}: no header: {line[:80]!r}")
        if name.lower() in out:
            raise WarcError(f"{what}: header {name} twice")
        out[name.lower()] = value.strip()
    return first, out, end + 4


def _length(headers: dict[str, str], what: str) -> int:
    value = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", value):
        raise WarcError(f"{what}: Content-Length is {value!r}")
    return int(value)


def parse_record(data: bytes) -> dict:
    """A decoded record's fields, after all checks; ``payload`` is None where the record has none."""
    first, head, at = _headers(data, "record")
    if not re.fullmatch(r"WARC/1\.[01]", first):
        raise WarcError(f"record: version line {first[:40]!r}")
    missing = [n for n in MANDATORY if n not in head]
    if missing:
        raise WarcError(f"record: without {', '.join(missing)}")
    size = _length(head, "record")
    if len(data) != at + size + 4 or data[at + size :] != b"\r\n\r\n":
        raise WarcError(f"record {head['warc-record-id']}: {len(data) - at - 4} bytes in the block, {size} announced, or no closing lines")
    out = {"record_type": head["warc-type"], "record_id": head["warc-record-id"], "date": head["warc-date"], "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"), "payload_bytes": None, "payload_digest": None, "payload": None}
    if head["warc-type"] not in ("response", "revisit"):
        return out
    block = data[at : at + size]
    status, http, start = _headers(block, "HTTP response")
    if not status.startswith("HTTP/"):
        raise WarcError(f"HTTP response: status line {status[:40]!r}")
    kind, _, value = head.get("warc-payload-digest", "").partition(":")
    if kind.lower() != "sha1":
        raise WarcError(f"record {out['record_id']}: no SHA-1 of the payload")
    digest = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    out["payload_bytes"], out["payload_digest"] = _length(http, "HTTP response"), digest.hex()
    if head["warc-type"] == "revisit":
        if "warc-refers-to" not in head or head.get("warc-profile") != REVISIT_PROFILE:
            raise WarcError(f"record {out['record_id']}: a revisit without profile or target")
        if start != size:
            raise WarcError(f"record {out['record_id']}: a revisit with a payload")
        return out
    payload = block[start:]
    if len(payload) != out["payload_bytes"]:
        raise WarcError(f"record {out['record_id']}: payload of {len(payload)} bytes, {out['payload_bytes']} announced")
    if hashlib.sha1(payload).digest() != digest:
        raise WarcError(f"record {out['record_id']}: payload differs from its digest")
    out["payload"] = payload
    return out


# ---- frames -----------------------------------------------------------------


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, by its block headers."""
    try:
        head = zstandard.frame_header_size(data[at : at + 18])
        checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise WarcError(f"frame at {at}: {e}") from e
    at += head
    while True:
        if at + 3 > len(data):
            raise WarcError(f"frame cut off at {len(data)}")
        word = int.from_bytes(data[at : at + 3], "little")
        kind = word >> 1 & 3
        if kind == 3:
            raise WarcError(f"frame with a reserved block at {at}")
        at += 3 + (1 if kind == 1 else word >> 3)
        if word & 1:
            break
    at += 4 * checksum
    if at > len(data):
        raise WarcError(f"frame cut off at {len(data)}")
    return at


def read_frames(archive: bytes) -> Iterator[bytes]:
    """The decoded record of each frame; the dictionary comes from the leading skippable frame, if there is one."""
    data = memoryview(archive)
    plain = zstandard.ZstdDecompressor()
    reader, at, leading = plain, 0, True
    while at < len(data):
        if at + 8 > len(data):
            raise WarcError(f"{len(data) - at} stray bytes at the end")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if at + 8 + size > len(data):
                raise WarcError(f"skippable frame cut off at {len(data)}")
            if magic == DICTIONARY:
                if not leading:
                    raise WarcError(f"dictionary at {at}, not in the leading frame")
                body = bytes(data[at + 8 : at + 8 + size])
                if body[:4] == struct.pack("<I", FRAME):
                    body = plain.decompressobj().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        elif magic == FRAME:
            end = frame_end(data, at)
            try:
                yield reader.decompressobj().decompress(bytes(data[at:end]))
            except zstandard.ZstdError as e:
                raise WarcError(f"frame at {at}: {e}") from e
            at = end
        else:
            raise WarcError(f"no frame at {at}")
        leading = False


# ---- tables -----------------------------------------------------------------


def train_dictionary(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS, size: int = DICTIONARY_BYTES, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A dictionary from the records of some pages, or nothing where they are too few to train on."""
    rows = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.substring(F.col("html").cast("string"), 1, sample_chars)).limit(sample_pages).collect()
    samples = [build_record(i, u, (h or "").encode("utf-8", "surrogatepass"), None, False, date) for i, u, h in rows]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def equal_payloads(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(payload_key, last_id): payloads of ``least`` bytes or more that occur twice or more, with the largest id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    thin = pages.select("page_id", F.octet_length(payload).alias("size"), F.sha2(payload, 256).alias("payload_key")).where(F.col("size") >= least)
    again = thin.groupBy("payload_key", "size").agg(F.max("page_id").alias("last_id"), F.count("*").alias("copies"))
    return again.where("copies > 1").select("payload_key", "size", "last_id")


def write_archives(
    pages: DataFrame, path: str, least: int = LEAST_BYTES, volume_bytes: int = VOLUME_BYTES, date: str = "1970-01-01T00:00:00Z", level: int = LEVEL
) -> None:
    """Write one record for each row of ``pages`` (page_id, url, html) into archives under ``path``."""
    dictionary = train_dictionary(pages, date=date)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    again = stage(equal_payloads(pages, least), "payloads")
    rows = rows.withColumn("payload_key", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload")).join(again, ["payload_key", "size"], "left")
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    rows = rows.select(F.col("page_id").cast("string"), "url", "payload", F.col("last_id").cast("string"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        lead = b""
        if known:
            trained = zstandard.ZstdCompressionDict(known)
            trained.precompute_compress(level=level)
            press = zstandard.ZstdCompressor(dict_data=trained, level=level, write_checksum=True)
            packed = zstandard.ZstdCompressor(level=level).compress(known)
            lead = struct.pack("<II", DICTIONARY, len(packed)) + packed
        else:
            press = zstandard.ZstdCompressor(level=level, write_checksum=True)
        frames, size = [], 0

        def volume() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lead + b"".join(frames)], pa.binary())], names=["archive"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, body, last, is_revisit = (batch.column(c)[i].as_py() for c in range(5))
                frames.append(press.compress(build_record(page_id, url, body, last, is_revisit, date)))
                size += len(frames[-1])
                if size >= volume_bytes:
                    yield volume()
                    frames, size = [], 0
        if frames:
            yield volume()

    archives = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``: ``archive``, ``record_id``, ``page_id`` (text), ``record_type``, ``date``,
    ``target_uri``, ``refers_to``, ``payload_bytes``, ``payload_digest`` (lower-case hex) and ``payload``
    (null in revisits, and everywhere if not asked for).  A broken archive or record is an error."""
    text = ("archive", "record_id", "page_id", "record_type", "date", "target_uri", "refers_to")
    schema = ", ".join([f"{n} string" for n in text] + ["payload_bytes bigint", "payload_digest string", "payload binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            kinds = [pa.string()] * len(text) + [pa.int64(), pa.string(), pa.binary()]
            names = [*text, "payload_bytes", "payload_digest", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                rows, size = [], 0
                try:
                    for data in read_frames(batch.column(1)[i].as_py() or b""):
                        r = parse_record(data)
                        r["archive"], r["page_id"] = name, _page_id(r["record_id"])
                        r["refers_to"] = None if r["refers_to"] is None else _page_id(r["refers_to"])
                        if not with_payload:
                            r["payload"] = None
                        size += len(r["payload"] or b"")
                        rows.append(r)
                        if len(rows) == 1000 or size >= 8_000_000:
                            yield out(rows)
                            rows, size = [], 0
                except WarcError as e:
                    raise WarcError(f"{name}: {e}") from e
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def through_archives(pages: DataFrame, least: int = LEAST_BYTES, volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """Write ``pages`` into archives in the session's shared folder and read them back, without payloads."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least, volume_bytes)
    track_staged(spark, path)
    records = read_archives(spark, path, with_payload=False)
    kind = pages.schema["page_id"].dataType
    return records.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def digest(records: DataFrame) -> DataFrame:
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS last_id, count(*) AS copies FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.copies > 1 AND g.last_id IS NOT NULL AND p.page_id IS DISTINCT FROM g.last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.copies > 1 AND p.page_id IS DISTINCT FROM g.last_id THEN g.last_id END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""

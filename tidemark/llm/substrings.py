"""Repeated passages: hashed windows dealt by their minimiser, in place of suffix trees.

A word is removed if it lies in a window of ``width`` (50) words that also starts
in a document with a smaller id.  Every window of every document is a suffix cut
at 50 words; two suffixes share a tree node of depth 50 exactly if their windows
are equal, so the deep nodes of the suffix trees give all repeats, and adjacent
positions under repeated nodes join into maximal ones.

Suffixes are dealt into groups by a key that depends on the window's
words alone, so equal windows meet:

* The short key is the hash of the window's least 8-word run.  Neighbouring
  windows mostly share it, so they travel as one record: position, count and an
  array of window hashes, about 8 bytes a word of text.
* A group over ``group_windows`` is dealt anew by a hash of all 50 words.
  These over-full keys are counted first; there are at most one for each
  ``group_windows`` windows of the corpus, which bounds what is broadcast.

Within a group the suffixes are ordered by the values of their 50-word labels, which
is not the order of their words; each run of equal labels stands for a tree's node of
depth 50, and its first document is the smallest one.  Labels are 64-bit hashes compared within
one chunk of one task only.  Before the shuffle each task does the same for the
documents of a chunk: a window already owned by a smaller document of the chunk
is settled there, so a passage in a third of all documents leaves each chunk once.

Defined results: null texts have no words; a document with a null id neither
removes words elsewhere nor loses any; documents with equal ids don't remove
each other's words; fewer than 50 words are never removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, stage, text_or_empty

WIDTH = 50
SHORT = 8
GROUP_WINDOWS = 4_000_000
PIECE = 2_000_000  # bytes hashed at once
CHUNK_WORDS = 600_000  # words whose windows are compared before the shuffle
FLUSH = 1_000_000  # windows ordered at once after it

_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95
NOTHING = (np.empty(0, np.uint64), np.empty(0, np.int64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``text``, hashed in pieces that end at white space."""
    out = []
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end = min((p for p in (text.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0), default=len(text))
        out.append(_hash_piece(text[at:end]))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _hash_piece(piece: bytes) -> np.ndarray:
    raw = np.frombuffer(piece, np.uint8)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(sizes.max()), _STEP, np.uint64))))
    sums = np.add.reduceat(_BYTE[raw[inside]] * powers[place], first)
    return mix(sums + sizes.astype(np.uint64) * np.uint64(_BASE))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words (composed from runs of powers of two)."""
    power = lambda k: np.uint64(pow(_BASE, k, 1 << 64))
    size, cur, done, have = 1, words, None, 0
    left = width
    while left:
        if left & 1:
            if done is None:
                done, have = cur, size
            else:  # what is composed so far comes after the run of this size
                n = len(words) - have - size + 1
                done = cur[:n] * power(have) + done[size : size + n]
                have += size
        left >>= 1
        if left:
            cur = cur[:-size] * power(size) + cur[size:]
            size *= 2
    return mix(done)


def sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    size, cur = 1, values
    while 2 * size <= span:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    return np.minimum(cur[: len(cur) - (span - size)], cur[span - size :])


class _Chunk:
    """The windows of some documents, in the order of their ids."""

    def __init__(self, docs: list[tuple[int, int, np.ndarray]], width: int, short: int):
        docs = sorted(docs, key=lambda d: d[0])
        sizes = np.array([len(w) for _, _, w in docs])
        words = np.concatenate([w for _, _, w in docs])
        self.ids = np.array([d[0] for d in docs], np.int64)
        self.keys = np.array([d[1] for d in docs], np.int64)
        offset = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(docs)), sizes)
        self.at = np.flatnonzero(doc[: len(words) - width + 1] == doc[width - 1 :]) if len(words) >= width else np.empty(0, np.int64)
        if not len(self.at):
            return
        self.doc = doc[self.at]
        self.hash = run_hashes(words, width)[self.at]
        self.prefix = sliding_min(run_hashes(words, short), width - short + 1)[self.at]
        self.place = self.at - offset[self.doc]

    def settled(self) -> np.ndarray:
        """Windows that a smaller document of this chunk has too."""
        return later_documents(self.hash, self.ids[self.doc])


def later_documents(label: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For suffixes in the order of their documents: is the first one of its node in a smaller document?"""
    order = np.argsort(label, kind="stable")
    ordered = label[order]
    head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    start = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = doc[order] > doc[order][start]
    return out


def _runs(keep: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of runs of consecutive kept windows over which all of ``same`` are equal: positions in ``keep``."""
    if not len(keep):
        return keep, keep
    cut = np.diff(keep) != 1
    for s in same:
        cut |= np.diff(s[keep].view(np.int64)) != 0
    first = np.concatenate(([0], np.flatnonzero(cut) + 1))
    return first, np.concatenate((first[1:], [len(keep)]))


def _chunks(batches: Iterator[pa.RecordBatch], width: int, short: int) -> Iterator[_Chunk]:
    docs, size = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if i is None or not text:
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                words = word_hashes(raw)
                if len(words) < width:
                    continue
                docs.append((i, xxhash.xxh64_intdigest(raw) - (1 << 63), words))
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield _Chunk(docs, width, short)
                    docs, size = [], 0
    if docs:
        yield _Chunk(docs, width, short)


def count_prefixes(docs: DataFrame, width: int, short: int) -> DataFrame:
    """(prefix, windows): how many windows each short prefix key will bring to its group, after the tasks' own settling."""

    def run(batches):
        for c in _chunks(batches, width, short):
            if len(c.at):
                prefix, n = np.unique(c.prefix[~c.settled()], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(prefix.view(np.int64)), pa.array(n)], names=["prefix", "windows"])

    return docs.mapInArrow(run, "prefix bigint, windows bigint").groupBy("prefix").agg(F.sum("windows").alias("windows"))


RECORD = "prefix bigint, part int, doc_id bigint, text_key bigint, at bigint, n bigint, labels binary"


def suffix_records(docs: DataFrame, width: int, short: int, over_full) -> DataFrame:
    """Records of unsettled windows by prefix; settled stretches come as records without labels."""

    def run(batches):
        keys, parts = over_full.value

        def batch(c: _Chunk, prefix, part, doc, at, n, labels) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(prefix.view(np.int64)), pa.array(part.astype(np.int32)), pa.array(c.ids[doc]), pa.array(c.keys[doc]), pa.array(at), pa.array(n), labels],
                names=["prefix", "part", "doc_id", "text_key", "at", "n", "labels"],
            )

        for c in _chunks(batches, width, short):
            if not len(c.at):
                continue
            settled = c.settled()
            done = np.flatnonzero(settled)
            first, last = _runs(done, c.doc, c.at - np.arange(len(c.at)))
            if len(first):
                w = done[first]
                yield batch(c, mix(c.hash[w]), np.zeros(len(w)), c.doc[w], c.place[w], last - first, pa.nulls(len(w), pa.binary()))
            split = np.zeros(len(c.at), np.int64)
            if len(keys):
                spot = np.minimum(np.searchsorted(keys, c.prefix), len(keys) - 1)
                hot = keys[spot] == c.prefix
                split[hot] = 1 + (c.hash[hot] >> np.uint64(32)) % parts[spot[hot]].astype(np.uint64)
            left = np.flatnonzero(~settled)
            first, last = _runs(left, c.doc, c.prefix, split, c.at - np.arange(len(c.at)))
            if len(first):
                w = left[first]
                offsets = np.concatenate((first, [len(left)])).astype(np.int32) * 8
                labels = pa.BinaryArray.from_buffers(pa.binary(), len(w), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(c.hash[left]))])
                yield batch(c, c.prefix[w], split[w], c.doc[w], c.place[w], last - first, labels)

    return docs.mapInArrow(run, RECORD)


def repeated_stretches(records: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, first, last): stretches of words [first, last) under repeated deep nodes.

    Records come dealt and sorted by (prefix, part), then by document.  Rows are
    gathered until there are enough windows to order at once; a group that goes
    on keeps its nodes' labels and first documents for the next round.
    """

    def run(batches):
        kept_key, kept = None, NOTHING
        rows: list[list[np.ndarray]] = []
        labels: list[np.ndarray] = []
        size = 0

        def out(doc, key, first, last) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(key), pa.array(first), pa.array(last)], names=["doc_id", "text_key", "first", "last"])

        def flush():
            nonlocal kept_key, kept, rows, labels, size
            prefix, part, doc, key, at, n = (np.concatenate(c) for c in zip(*rows))
            label = np.concatenate(labels)
            rows, labels, size = [], [], 0
            new = np.concatenate(([True], (np.diff(prefix) != 0) | (np.diff(part) != 0)))
            group = np.cumsum(new) - 1
            last_key = (prefix[-1], part[-1])
            lead = kept if kept_key == (prefix[0], part[0]) else NOTHING
            # a group of one document can't have a repeat across documents
            head = np.flatnonzero(new)
            differs = np.maximum.reduceat(doc, head) != np.minimum.reduceat(doc, head)
            if len(lead[0]):
                differs[0] = True
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            use = np.flatnonzero(differs[group[row]])
            mixed = mix(prefix.view(np.uint64) + part.astype(np.uint64) * np.uint64(_STEP))
            found = np.empty(0, np.int64)
            if len(use):
                lead_label = lead[0] ^ mixed[0]
                again = later_documents(np.concatenate((lead_label, label[use] ^ mixed[row[use]])), np.concatenate((lead[1], doc[row[use]])))
                found = use[again[len(lead_label) :]]
            mine = np.flatnonzero(group[row] == group[-1])
            old = kept if kept_key == last_key else NOTHING
            all_docs = np.concatenate((old[1], doc[row[mine]]))
            # the first of equal labels belongs to the smallest document
            nodes, where = np.unique(np.concatenate((old[0], label[mine])), return_index=True)
            kept_key, kept = last_key, (nodes, all_docs[where])
            if len(found):
                a, b = _runs(found, row)
                w = found[a]
                yield out(doc[row[w]], key[row[w]], at[row[w]] + step[w], at[row[w]] + step[w] + (b - a) - 1 + width)

        for batch in batches:
            null = batch.column(6).is_null().to_numpy(zero_copy_only=False)
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if null.any():
                _, _, doc, key, at, n = (c[null] for c in cols)
                yield out(doc, key, at, at + n - 1 + width)
            if null.all():
                continue
            rows.append([c[~null] for c in cols])
            labels.append(np.frombuffer(b"".join(batch.column(6).drop_null().to_pylist()), np.uint64))
            size += len(labels[-1])
            if size >= FLUSH:
                yield from flush()
        if size:
            yield from flush()

    return records.mapInArrow(run, "doc_id bigint, text_key bigint, first bigint, last bigint")


def repeated_passages(docs: DataFrame, width: int = WIDTH, short: int = SHORT, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """(doc_id, text_key, stretches): for every text with repeats, its stretches of repeated words."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    over = (
        count_prefixes(texts, width, short)
        .where(F.col("windows") > group_windows)
        .select("prefix", F.ceil(2 * F.col("windows") / group_windows).cast("long").alias("parts"))
        .toPandas()
    )
    keys = over["prefix"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], over["parts"].to_numpy(np.int64)[order]))
    records = suffix_records(texts, width, short, shared)
    dealt = records.repartition("prefix", "part").sortWithinPartitions("prefix", "part", "doc_id")
    found = repeated_stretches(dealt, width)
    return stage(
        found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("stretches")), "stretches"
    )


def remove_repeats(docs: DataFrame, width: int = WIDTH, short: int = SHORT, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """For every document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (the kept words
    joined by one space) and ``stretches`` (of repeated words, as word numbers [first, last))."""
    stretches = repeated_passages(docs, width, short, group_windows)
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def pack():
        press = zstandard.ZstdCompressor(level=3)

        def go(texts: list[str]) -> dict[str, list]:
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            return {
                "text_key": [xxhash.xxh64_intdigest(r) - (1 << 63) for r in raw],
                "packed": [press.compress(b" ".join(r.split())) for r in raw],
            }

        return go

    # the words travel compressed to the join with their stretches
    packed = map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("packed_text")), pack, [("text_key", pa.int64()), ("packed", pa.binary())], "packed_text")
    joined = packed.join(stretches, ["doc_id", "text_key"], "left").select("doc_id", "packed", "stretches")

    def cut(batches):
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, removed, kept = [], [], []
                for blob, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = press.decompress(blob).split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s in spans or ():
                        gone[s["first"]] += 1
                        gone[s["last"]] -= 1
                    left = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    n.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(words if len(left) == len(words) else [words[i] for i in left]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array([k.decode("utf-8", "surrogatepass") for k in kept]),
                        pa.array([s or [] for s in part.column(2).to_pylist()], pa.list_(span)),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "stretches"],
                )

    return joined.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, stretches array<struct<first:bigint,last:bigint>>")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def brute(rows: list[tuple[int | None, str | None]], width: int = WIDTH) -> list[tuple]:
    """The contract by plain Python, for tests."""
    first: dict[tuple, int] = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            s = tuple(w[k : k + width])
            if i is not None:
                first[s] = min(i, first.get(s, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return out

"""SimHash near-duplicates found through anchor points of a covering code.

Fingerprints are 64 bits; each bit is the majority vote of the XXH64 values of
the text's word shingles.  Two fingerprints are linked at ``max_bits`` differing
bits or fewer.  Links are found by anchor-point covering:

* The 64 bits are read in ``parts`` equal parts.  A pair within ``max_bits`` is
  within ``max_bits // parts`` in at least one part, so each part searches with
  that smaller threshold ``t`` and the union of the parts is complete.
* The anchors of a part are the words of a Hamming code of the largest length
  ``2**r - 1`` that fits.  The code is perfect: every point is within covering
  radius 1 of exactly one anchor, its home.
* Each fingerprint is replicated to every anchor within ``1 + t`` of it.  If x
  and y differ in at most t bits of the part, y reaches the home of x by the
  triangle inequality, so the pair meets there.  Comparing the homes of an
  anchor with all its members, over the full 64 bits, misses no link.

With two parts a fingerprint goes to 16 of 2**26 anchors for each part.  Before
replication equal fingerprints are merged (with map-side aggregation), so a
group of copies is one row.  An anchor that is home to more than ``chunk``
fingerprints is split: its homes are dealt over chunks and its members visit
each.  Inside an anchor only a spanning forest of the links is kept, never the
pairs.  Components come from alternating large-star and small-star steps over
those links, each step staged in the shared checkpoint folder.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; a null id is never the smallest unless a component has no other (then
the component id is null); repeated rows stay as they are; ties don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, stage

SEED = 42
LANES = np.uint64(0x0101010101010101)
BLOCK = 255  # rows that a byte lane can count
CHUNK = 4096


def _shingle_hashes(text: str, width: int) -> list[int]:
    w = text.encode("utf-8", "surrogatepass").lower().split()  # both know ASCII only: A-Z, and \x20\x09-\x0D
    if not w:
        return []
    digest = xxhash.xxh64_intdigest
    if len(w) <= width:
        return [digest(b" ".join(w), SEED)]
    if width == 3:
        return [digest(b"%b %b %b" % s, SEED) for s in zip(w, w[1:], w[2:])]
    return [digest(b" ".join(w[i : i + width]), SEED) for i in range(len(w) - width + 1)]


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; no hashes give zero."""
    n = len(hashes)
    if not n:
        return 0
    at = np.arange(0, n, BLOCK)
    counts = np.empty((8, 8), np.int64)  # byte, bit in the byte
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, at)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, axis=1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text") -> DataFrame:
    """All columns but the text, plus ``fp``: the fingerprint as a signed long."""

    def make():
        def one(t: str) -> int:
            v = majority(np.array(_shingle_hashes(t, width), np.uint64))
            return v - (1 << 64) if v >> 63 else v

        return lambda texts: {"fp": [one(t) for t in texts]}

    return map_texts(docs, make, [("fp", pa.int64())], text)


def code_length(bits: int) -> int:
    """Length of the longest Hamming code within ``bits``."""
    r = (bits + 1).bit_length() - 1
    return (1 << r) - 1


def error_patterns(length: int, weight: int) -> list[np.ndarray]:
    """By syndrome, all patterns of at most ``weight`` bits that lead to a codeword from a point with it."""
    out: list[list[int]] = [[] for _ in range(length + 1)]
    for k in range(weight + 1):
        for places in combinations(range(1, length + 1), k):
            s, mask = 0, 0
            for p in places:
                s ^= p
                mask |= 1 << (p - 1)
            out[s].append(mask)
    return [np.array(v, np.uint64) for v in out]


def syndromes(points: np.ndarray, length: int) -> np.ndarray:
    """XOR of the places (from 1) of the set bits."""
    s = np.zeros(len(points), np.int64)
    for p in range(1, length + 1):
        s ^= np.where((points >> np.uint64(p - 1)) & np.uint64(1), p, 0)
    return s


def to_anchors(fps: DataFrame, max_bits: int, parts: int) -> DataFrame:
    """Rows (part, anchor, home, fp): each fingerprint at every anchor within radius + threshold."""
    bits = 64 // parts
    length, near = code_length(bits), max_bits // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_syndrome = error_patterns(length, 1 + near)
        most = max(map(len, by_syndrome))
        table = np.zeros((length + 1, most), np.uint64)
        there = np.zeros((length + 1, most), bool)
        for s, masks in enumerate(by_syndrome):
            table[s, : len(masks)] = masks
            there[s, : len(masks)] = True
        for batch in batches:
            for lo in range(0, batch.num_rows, max(1, 1_000_000 // most)):
                fp = batch.column(0).slice(lo, max(1, 1_000_000 // most)).to_numpy(zero_copy_only=False)
                for part in range(parts):
                    point = (fp.view(np.uint64) >> np.uint64(part * bits)) & np.uint64((1 << length) - 1)
                    s = syndromes(point, length)
                    home = point ^ np.where(s > 0, np.uint64(1) << np.maximum(s - 1, 0).astype(np.uint64), np.uint64(0))
                    anchors = point[:, None] ^ table[s]
                    ok = there[s]
                    who = np.broadcast_to(np.arange(len(fp))[:, None], anchors.shape)[ok]
                    anchor = anchors[ok]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(anchor), part, np.int32)),
                            pa.array(anchor.view(np.int64)),
                            pa.array(anchor == home[who]),
                            pa.array(fp[who]),
                        ],
                        names=["part", "anchor", "home", "fp"],
                    )

    return fps.select("fp").mapInArrow(run, "part int, anchor bigint, home boolean, fp bigint")


class _Anchor:
    """One anchor chunk: its homes, and which of them are known to be connected."""

    def __init__(self, key: tuple, homes: np.ndarray, max_bits: int):
        self.key, self.homes, self.max_bits = key, homes, max_bits
        self.label = np.arange(len(homes))

    def links(self, members: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links that connect the members to the homes; a link within a component is left out."""
        for lo in range(0, len(members), 1024):
            block = members[lo : lo + 1024]
            close = np.bitwise_count(block[:, None].view(np.uint64) ^ self.homes[None, :].view(np.uint64)) <= self.max_bits
            first = close.argmax(axis=1)
            hit = close[np.arange(len(block)), first]
            for m, f in zip(block[hit], first[hit]):
                if m != self.homes[f]:
                    yield int(m), int(self.homes[f])
            while True:
                low = np.where(close, self.label, len(self.homes)).min(axis=1)
                high = np.where(close, self.label, -1).max(axis=1)
                split = np.flatnonzero(low < high)
                if not len(split):
                    break
                for i in split:
                    labels = np.unique(self.label[close[i]])
                    for x in labels:
                        home = self.homes[np.flatnonzero(close[i] & (self.label == x))[0]]
                        if block[i] != home:
                            yield int(block[i]), int(home)
                        self.label[self.label == x] = labels[0]


def compare_at_anchors(at: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that span each anchor's components.

    ``at`` holds (part, anchor, chunk, home, fp), dealt by the first three and
    sorted by them with homes first.  Groups stream through: only an anchor's
    homes are held, its members pass in batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Anchor | None = None
        held_key, held = None, []  # an anchor whose homes may not have all come

        def emit(pairs) -> Iterator[pa.RecordBatch]:
            rows = list(pairs)
            if rows:
                a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        def all_links(key, homes, members, more):
            anchor = _Anchor(key, homes, max_bits)
            return anchor, list(anchor.links(members)) if len(members) > 1 or more else []

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            part, anchor, chunk, home, fp = cols
            change = (np.diff(part) != 0) | (np.diff(anchor) != 0) | (np.diff(chunk) != 0)
            starts = np.concatenate(([0], np.flatnonzero(change) + 1))
            ends = np.concatenate((starts[1:], [len(fp)]))
            homes_in = np.add.reduceat(home.astype(np.int64), starts)
            last = len(starts) - 1
            # of the groups in the middle only those with a home and another member can have a link
            for g in np.flatnonzero((homes_in > 0) & (ends - starts > 1) | (np.arange(last + 1) == 0) | (np.arange(last + 1) == last)):
                s, e = starts[g], ends[g]
                key = (part[s], anchor[s], chunk[s])
                members = fp[s:e]
                h = int(homes_in[g])
                pairs: list[tuple[int, int]] = []
                if now is not None and now.key == key:
                    pairs = list(now.links(members))
                else:
                    now = None
                    if held_key == key:
                        members = np.concatenate([*held, members])
                        h += sum(map(len, held))
                    elif held_key is not None:
                        kept = np.concatenate(held)
                        pairs += all_links(held_key, kept, kept, False)[1]
                    held_key, held = None, []
                    if g == last and h == len(members):  # only homes so far: more may follow
                        held_key, held = key, [members]
                    elif h:
                        now, found = all_links(key, members[:h], members, g == last)
                        pairs += found
                yield from emit(pairs)
        if held_key is not None:
            kept = np.concatenate(held)
            yield from emit(all_links(held_key, kept, kept, False)[1])

    return at.mapInArrow(run, "a bigint, b bigint")


def near_links(fps: DataFrame, max_bits: int = 3, parts: int = 2, chunk: int = CHUNK) -> DataFrame:
    """Links between distinct fingerprints: a set of pairs with the components of all links."""
    at = to_anchors(fps, max_bits, parts)
    key = ["part", "anchor"]
    # only an anchor that is home to many is split; this counts homes, one for each fingerprint and part
    homes = at.where("home").groupBy(*key).agg(F.count("*").alias("homes"))
    hot = homes.where(F.col("homes") > chunk).select(*key, F.ceil(F.col("homes") / chunk).cast("int").alias("chunks"))
    spread = (
        at.join(hot, key, "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("home", F.col("home") & (F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int") == F.col("chunk")))
    )
    dealt = spread.select(*key, "chunk", "home", "fp").repartition(*key, "chunk").sortWithinPartitions(*key, "chunk", F.desc("home"), "fp")
    return compare_at_anchors(dealt, max_bits).distinct()


def connected_components(links: DataFrame, tag: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b), for every node with a link.

    Alternates large-star and small-star steps until the links no longer change;
    each step is written to the shared checkpoint folder.  Only counts reach the driver.
    """
    edges = stage(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), tag
    )

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: each larger neighbour hangs on the least of u's neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: u and its smaller neighbours hang on the least of them
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), tag)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def simhash_components(
    docs: DataFrame, width: int = 3, max_bits: int = 3, parts: int = 2, carry: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK, group_key: bool = False
) -> DataFrame:
    """``carry`` columns of every document (``doc_id`` among them), ``fp`` and ``component_id``:
    the smallest id among the documents reachable over links of at most ``max_bits`` bits.

    With ``group_key`` also ``root``, which tells components without any id apart."""
    seen = stage(fingerprints(docs.select(*carry, F.col("text").cast("string").alias("text_")), width, "text_"), "fingerprints")
    nodes = stage(seen.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = stage(connected_components(near_links(nodes, max_bits, parts, chunk)), "roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return seen.join(by_fp, "fp").select(*carry, "fp", *["root"] * group_key, "component_id")


def keep_one(docs: DataFrame, width: int = 3, max_bits: int = 3, parts: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the smallest id (null last), of equal ids the smallest
    hash of the text, and of equal rows one."""
    text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.select("doc_id", "text", text_key.alias("text_key"))
    found = stage(simhash_components(keyed, width, max_bits, parts, carry=("doc_id", "text_key"), group_key=True), "found")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    picks = found.groupBy("root").agg(F.min(order).alias("pick")).select("pick.doc_id", "pick.text_key")
    picks = stage(picks.select(F.col("doc_id").alias("simhash_id"), F.col("text_key").alias("simhash_key")), "picks")
    again = stage(found.groupBy("doc_id", "text_key").count().where("count > 1").select(F.col("doc_id").alias("simhash_id"), F.col("text_key").alias("simhash_key")), "again")
    same = docs["doc_id"].eqNullSafe(F.col("simhash_id")) & (text_key == F.col("simhash_key"))
    kept = docs.join(picks, same, "left_semi")
    same = kept["doc_id"].eqNullSafe(F.col("simhash_id")) & (text_key == F.col("simhash_key"))
    # rows that stand more than once are few, and only they are compared
    doubled = kept.join(again, same, "left_semi").withColumn("simhash_text_key", text_key)
    return kept.join(again, same, "left_anti").unionByName(doubled.dropDuplicates(["doc_id", "simhash_text_key"]).drop("simhash_text_key"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Phrase collocations from depth-truncated suffix trees, partitioned by word prefixes.

The suffixes of a language's texts are the up to ``depth`` words that begin at each word
and stay in its piece.  In the tree of all of them the leaf totals under a node are the
occurrences of the node's phrase, overlaps included, and the root's are all words.

1. Leaves.  Each task cuts its texts into chunks of ``chunk_words`` words and sorts a
   chunk's suffixes; equal ones leave it as one leaf with its total.  Leaves travel packed,
   by a hash of their words, to tasks that add the totals of equal ones.
2. Vertical partitioning.  A leaf belongs to its first word; where a prefix has more than
   ``group_leaves`` leaves, its leaves belong to the prefix of one word more, until every
   prefix fits or is a whole leaf.  The prefixes are packed in their order into groups of
   about ``group_leaves`` by range partitioning.
3. Subtrees.  Each group builds the subtrees of its prefixes by itself: its leaves come
   sorted by Spark, the words shared with the leaf before give the nodes that close, and
   a node's count is the sum of the leaf totals under it.  A node above a grown prefix is
   spread over groups and is summed once more.

No phrase under ``least`` is wanted, so a suffix ends before its first run of two or three
words that can't occur so often, and a word that can't is an empty leaf.  What can't comes
from a sketch: words and runs of two and three are counted in hash buckets, and a bucket
under ``least`` holds none that occurs so often.  The sketch has a bucket for each ``SKETCH_BYTES`` bytes of text,
``SKETCH_MAX`` at most (a bitmap of 16 MB, the only thing of its kind that is broadcast);
where it is too coarse more leaves travel, and the counts stay exact.

Scoring joins phrases of ``least`` or more with their own parts, in the JVM; products are
decimals of 38 digits.  The first rows of a language come from Spark's partial top-k.

What is broadcast else: prefixes with over ``group_leaves`` leaves, at most one for each
``group_leaves`` leaves and word of depth.

Defined results: a null text is empty; a null language is ``und``; an empty table has no
phrases; repeated rows count each time; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

DEPTH, LEAST, TOP = 5, 100, 2000
CHUNK_WORDS = 2_000_000
GROUP_LEAVES = 2_000_000
SKETCH_BYTES, SKETCH_MIN, SKETCH_MAX = 32, 1 << 16, 1 << 27
SLICE = 1 << 15  # buckets that travel together
#: Leaves of a packed row, leaves that a task holds while it adds totals, and the bytes of text for which there is a group of such tasks.
PACK, HELD_LEAVES, GROUP_BYTES = 50_000, 400_000, 32_000_000
#: A-Z lower-cased, all piece ends as line ends, tabs as spaces.
TABLE = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))
#: Words of a leaf are parted by the least byte, so that leaves sort word by word; it and its mark are escaped in words.
JOIN, MARK = "\0", "\1"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Numbers of a language's words in a chunk."""

    def __init__(self, chunk: Chunk, lang: int):
        self.chunk, self.lang = chunk, lang

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.chunk.words)
        self.chunk.words.append(word)
        self.chunk.lang_of.append(self.lang)
        return n


class Chunk:
    """Words of some texts as numbers, with the words left in their pieces."""

    def __init__(self):
        self.words: list[bytes] = []
        self.lang_of: list[int] = []
        self.langs: dict[str, int] = {}
        self._by_lang: list[_Words] = []
        self._ids: list[np.ndarray] = []
        self._sizes: list[int] = []
        self._n = 0

    def add(self, text: bytes, lang: str) -> None:
        """Adds whole pieces; longer texts are fed in parts that end with a piece."""
        k = self.langs.setdefault(lang, len(self.langs))
        if k == len(self._by_lang):
            self._by_lang.append(_Words(self, k))
        number = self._by_lang[k].__getitem__
        ids: list[int] = []
        for piece in text.split(b"\n"):
            words = piece.split(b" ")
            if b"" in words:
                words = [w for w in words if w]
            if words:
                ids += map(number, words)
                self._sizes.append(len(words))
        self._ids.append(np.array(ids, np.int32))
        self._n += len(ids)

    def __len__(self) -> int:
        return self._n

    def freeze(self) -> None:
        self.ids = np.concatenate(self._ids)
        self._ids.clear()
        sizes = np.array(self._sizes, np.int32)
        self.left = np.repeat(np.cumsum(sizes, dtype=np.int32), sizes) - np.arange(len(self.ids), dtype=np.int32)
        names = {k: xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) for n, k in self.langs.items()}
        self.hash = np.array([xxhash.xxh64_intdigest(w, names[k]) for w, k in zip(self.words, self.lang_of)], np.uint64)

    def buckets(self, size: int) -> list[np.ndarray]:
        """Sketch buckets of the distinct words, and of the runs of two and of three words in their order."""
        shift = np.uint64(64 - int(size).bit_length() + 1)
        h = self.hash[self.ids]
        out = [_mix(self.hash)]
        for k in (1, 2):
            at = np.flatnonzero(self.left > k)
            run = h[at] * _A + h[at + 1]
            if k == 2:
                run = _mix(run) * _B + h[at + 2]
            out.append(_mix(run))
        return [(x >> shift).astype(np.uint32) for x in out]


def chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[Chunk]:
    cur = Chunk()
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass").translate(TABLE)
                at = 0
                while at < len(raw):
                    # a very long text is fed in parts that end with a piece
                    end = raw.find(b"\n", at + 8 * chunk_words)
                    end = len(raw) if end < 0 else end + 1
                    cur.add(raw[at:end], lang)
                    at = end
                    if len(cur) >= chunk_words:
                        cur.freeze()
                        yield cur
                        cur = Chunk()
    if len(cur):
        cur.freeze()
        yield cur


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def frequent_buckets(texts: DataFrame, size: int, least: int, chunk_words: int) -> np.ndarray:
    """A bitmap of the ``size`` buckets that words and runs of two and three fill ``least`` times or more."""
    kind = np.uint16 if least < 1 << 16 else np.int64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, chunk_words):
            word, pair, triple = c.buckets(size)
            at, total = np.unique(np.concatenate((word[c.ids], pair, triple)), return_counts=True)
            total = np.minimum(total, least).astype(kind)
            part = (at // np.uint32(SLICE)).astype(np.int64)
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            bounds = np.append(cut, len(part))
            place = (at % np.uint32(SLICE)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[cut]),
                    pa.array([place[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                    pa.array([total[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                ],
                names=["slice", "place", "times"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, sums = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([cur]), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], names=["slice", "bits"])

        for batch in batches:
            for s, place, times in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != cur:
                    if cur is not None:
                        yield out()
                    cur, sums = s, np.zeros(SLICE, np.int64)
                sums[np.frombuffer(place, np.uint16)] += np.frombuffer(times, kind)
        if cur is not None:
            yield out()

    counted = texts.mapInArrow(count, "slice bigint, place binary, times binary")
    merged = counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(add, "slice bigint, bits binary")
    # bounded: a bit for each bucket
    out = np.zeros(size // 8, np.uint8)
    for r in merged.toLocalIterator():
        out[r.slice * SLICE // 8 : (r.slice + 1) * SLICE // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def _bit(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bitmap[bucket >> np.uint32(3)] >> (np.uint8(7) - (bucket & np.uint32(7)).astype(np.uint8))) & 1 == 1


def chunk_leaves(c: Chunk, bitmap: np.ndarray, size: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places, depths and totals of a chunk's distinct leaves."""
    word, pair, triple = c.buckets(size)
    n = len(c.ids)
    alive = _bit(bitmap, word)[c.ids]
    two, three = np.zeros(n, bool), np.zeros(n, bool)
    two[c.left > 1], three[c.left > 2] = _bit(bitmap, pair), _bit(bitmap, triple)
    deep = alive.astype(np.int8)
    # word k + 1 joins if the runs of two and three words that it ends are frequent
    for k in range(1, depth):
        alive[: n - k] &= two[k - 1 : n - 1]
        if k > 1:
            alive[: n - k] &= three[k - 2 : n - 2]
        alive[max(0, n - k) :] = False
        deep += alive
    # leaves that are alike in k words get one number, by pairs of (number, next word); a language has one empty leaf
    many = len(c.words)
    code = np.where(deep > 0, c.ids, many + np.array(c.lang_of, np.int64)[c.ids])
    used = many + len(c.langs)
    for k in range(1, depth):
        some = np.flatnonzero(deep > k)
        if not len(some):
            break
        new, number = np.unique(code[some] * many + c.ids[some + k], return_inverse=True)
        code[some] = used + number
        used += len(new)
    total = np.bincount(code, minlength=used)
    first = np.zeros(used, np.int64)
    first[code[::-1]] = np.arange(n - 1, -1, -1)
    there = np.flatnonzero(total)
    first = first[there]
    return first, deep[first], total[there]


def _escape(word: bytes) -> str:
    if b"\0" in word or b"\1" in word:
        word = word.replace(b"\1", b"\1\3").replace(b"\0", b"\1\2")
    return word.decode("utf-8", "surrogatepass")


def _unescape(word: str) -> str:
    return word.replace("\1\2", "\0").replace("\1\3", "\1") if MARK in word else word


def leaf_groups(c: Chunk, first: np.ndarray, deep: np.ndarray, groups: int) -> np.ndarray:
    """The group that a leaf's totals are added in: a hash of its words."""
    h = c.hash[c.ids[first]].copy()
    h[deep == 0] = np.array(c.lang_of, np.uint64)[c.ids[first[deep == 0]]]
    for k in range(1, int(deep.max(initial=0))):
        some = np.flatnonzero(deep > k)
        h[some] = _mix(h[some] * _A + c.hash[c.ids[first[some] + k]])
    return (_mix(h) % np.uint64(groups)).astype(np.int64)


def leaves(texts: DataFrame, bitmap: np.ndarray, size: int, depth: int = DEPTH, chunk_words: int = CHUNK_WORDS, groups: int = 1) -> DataFrame:
    """(lang, leaf, total): the distinct leaves; the empty leaf holds the suffixes that can't be wanted.

    A chunk's leaves travel packed, a row for each language and group; the tasks of the groups add
    the totals of equal leaves before they become rows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for c in chunks(batches, chunk_words):
            first, deep, total = chunk_leaves(c, shared.value, size, depth)
            names = [_escape(w) for w in c.words]
            langs = list(c.langs)
            key = np.array(c.lang_of, np.int64)[c.ids[first]] * groups + leaf_groups(c, first, deep, groups)
            order = np.argsort(key, kind="stable")
            bounds = [*np.flatnonzero(np.diff(key[order], prepend=-1)), len(order)]
            rows: list[tuple] = []
            for lo, hi in zip(bounds, bounds[1:]):
                for at in range(lo, hi, PACK):
                    some = order[at : min(hi, at + PACK)]
                    text = "\n".join(JOIN.join([names[x] for x in c.ids[a : a + k]]) for a, k in zip(first[some].tolist(), deep[some].tolist()))
                    k = int(key[some[0]])
                    rows.append((k % groups, langs[k // groups], press.compress(text.encode("utf-8", "surrogatepass")), total[some].astype(np.int64).tobytes()))
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["part", "lang", "leaves", "totals"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        sums: dict[tuple[str, str], int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            keys, values = list(sums), list(sums.values())
            sums.clear()
            for lo in range(0, len(keys), PACK):
                some = keys[lo : lo + PACK]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in some], pa.string()), pa.array([k[1] for k in some], pa.string()), pa.array(values[lo : lo + PACK], pa.int64())], names=["lang", "leaf", "total"])

        for batch in batches:
            for i in range(batch.num_rows):
                lang = batch.column(1)[i].as_py()
                text = unpack.decompress(batch.column(2)[i].as_py()).decode("utf-8", "surrogatepass")
                for leaf, n in zip(text.split("\n"), np.frombuffer(batch.column(3)[i].as_py(), np.int64).tolist()):
                    sums[lang, leaf] = sums.get((lang, leaf), 0) + n
                if len(sums) >= HELD_LEAVES:
                    yield from out()
        yield from out()

    packed = texts.mapInArrow(pack, "part bigint, lang string, leaves binary, totals binary")
    added = packed.repartition(groups, "part").mapInArrow(add, "lang string, leaf string, total bigint")
    # a task that holds too many leaves gives some of them twice
    return added.groupBy("lang", "leaf").agg(F.sum("total").alias("total"))


def prefixed(found: DataFrame, depth: int, group_leaves: int) -> DataFrame:
    """Leaves with their ``prefix``: the fewest words that at most ``group_leaves`` leaves share, or the whole leaf.

    ``whole`` is the least number of words that no other group has leaves of.
    """
    spark = found.sparkSession
    first = lambda k: F.substring_index("leaf", JOIN, k)
    prefix, grown = first(1), []
    for k in range(1, depth):
        # only leaves under a prefix that was too large before are counted again
        at = found.withColumn("prefix", first(k))
        if k > 1:
            at = at.join(grown[-1], (F.col("lang") == F.col("big_lang")) & (first(k - 1) == F.col("big_prefix")), "left_semi")
        over = at.groupBy("lang", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > group_leaves)
        # bounded: at most one for each group_leaves leaves
        rows = [(r.lang, r.prefix) for r in over.select("lang", "prefix").toLocalIterator()]
        if not rows:
            break
        big = F.broadcast(spark.createDataFrame(rows, "big_lang string, big_prefix string"))
        grown.append(big)
    out = found.withColumn("prefix", prefix).withColumn("whole", F.lit(1))
    for k, big in enumerate(grown, 1):
        marked = big.withColumn("grown_", F.lit(True))
        out = out.join(marked, (F.col("lang") == F.col("big_lang")) & (F.col("prefix") == F.col("big_prefix")), "left")
        out = out.withColumn("prefix", F.when(F.col("grown_"), first(k + 1)).otherwise(F.col("prefix")))
        out = out.withColumn("whole", F.when(F.col("grown_"), k + 1).otherwise(F.col("whole"))).drop("big_lang", "big_prefix", "grown_")
    return out


def subtree_counts(dealt: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, n): nodes of the subtrees from leaves sorted by (lang, prefix, leaf).

    Nodes above a leaf's prefix are in several groups and come with what this group has of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = None
        path: list[str] = []
        sums: list[int] = []
        whole = 1  # nodes from this depth on are in this group only
        rows: list[tuple] = []

        def close(to: int) -> None:
            while len(path) > to:
                n = sums.pop()
                if n >= least or len(path) < whole:
                    rows.append((lang, " ".join(map(_unescape, path)), len(path), n))
                path.pop()
                if sums:
                    sums[-1] += n

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))], names=["lang", "phrase", "words", "n"])
            rows.clear()
            return batch

        for batch in batches:
            for new_lang, new_whole, leaf, total in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = leaf.split(JOIN)
                same = 0
                if new_lang == lang:
                    while same < min(len(words), len(path)) and words[same] == path[same]:
                        same += 1
                close(same)
                lang, whole = new_lang, new_whole
                path += words[same:]
                sums += [0] * (len(words) - same)
                sums[-1] += total
                if len(rows) >= 20_000:
                    yield out()
        close(0)
        if rows:
            yield out()

    return dealt.select("lang", "whole", "leaf", "total").mapInArrow(run, "lang string, phrase string, words int, n bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, chunk_words: int = CHUNK_WORDS, group_leaves: int = GROUP_LEAVES, sketch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of phrases of 1 to ``depth`` words that occur ``least`` times or more, and (lang, n) of all words."""
    texts = texts_of(docs)
    size = int(texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    if sketch is None:
        sketch = min(SKETCH_MAX, max(SKETCH_MIN, 1 << (size // SKETCH_BYTES).bit_length()))
    bitmap = frequent_buckets(texts, sketch, least, chunk_words)
    found = stage(leaves(texts, bitmap, sketch, depth, chunk_words, max(1, -(-size // GROUP_BYTES))), "leaves")
    words = found.groupBy("lang").agg(F.sum("total").alias("n"))
    kept = found.where("leaf != ''")
    groups = max(1, -(-kept.count() // group_leaves))
    dealt = prefixed(kept, depth, group_leaves).repartitionByRange(groups, "lang", "prefix").sortWithinPartitions("lang", "prefix", "leaf")
    counts = subtree_counts(dealt, least).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stage(counts, "phrases"), words


def _words_of(k_from, k_to):
    """The phrase's words [k_from, k_to), joined by a space."""
    return F.array_join(F.slice("parts", k_from + 1, k_to - k_from), " ")


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP, **options) -> DataFrame:
    """Each language's ``top`` phrases by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts, totals = phrase_counts(docs, least, depth, **options)
    f = lambda name: counts.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("n").alias(name))
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
    # a candidate goes where a longer one holds it as often
    spans = [(i, j) for i in range(depth) for j in range(i + 2, depth + 1) if j - i < depth]
    inside = candidates.where("words >= 3").select(
        "lang", "a", F.explode(F.filter(F.array(*[F.when(F.col("words") >= j, F.when(F.col("words") > j - i, _words_of(F.lit(i), F.lit(j)))) for i, j in spans]), lambda p: p.isNotNull())).alias("phrase")
    )
    held = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer")).select(F.col("lang").alias("h_lang"), F.col("phrase").alias("h_phrase"), "longer")
    left = candidates.join(held, (F.col("lang") == F.col("h_lang")) & (F.col("phrase") == F.col("h_phrase")), "left")
    left = left.where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a"))).select("lang", "phrase", "a", "words", "parts")
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"), "parts", "words").select(
        "lang", "phrase", "a", "k", _words_of(F.lit(0), F.col("k")).alias("head"), _words_of(F.col("k"), F.col("words")).alias("rest")
    )
    cuts = cuts.join(f("l"), (F.col("lang") == F.col("l_lang")) & (F.col("head") == F.col("l_phrase"))).join(f("r"), (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
    wide = lambda c: F.col(c).cast("decimal(17,0)")
    # a row for each language
    cuts = cuts.join(totals.select(F.col("lang").alias("n_lang"), "n"), F.col("lang") == F.col("n_lang"))
    cuts = cuts.withColumn("num", (wide("a") * 1000).cast("decimal(20,0)") * wide("n")).withColumn("den", wide("l") * wide("r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("num div den").alias("score"), "k", "l", "r")).alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (
        scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
grams AS (SELECT lang, i, w, unnest(range(1, 6)) AS m FROM starts),
f AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS f FROM grams WHERE i + m - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS p FROM f WHERE m >= 2 AND f >= 100),
sub AS (SELECT lang, a, m, p, unnest(range(1, m + 1)) AS i FROM c),
subs AS (SELECT lang, a, m, p, i, unnest(range(2, 5)) AS k FROM sub),
longer AS (SELECT lang, array_to_string(p[i:i + k - 1], ' ') AS phrase, max(a) AS longer FROM subs WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE longer.longer IS NULL OR 100 * longer.longer < 100 * c.a),
cuts AS (SELECT lang, phrase, m, a, p, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cuts.k, x.f AS l, y.f AS r, n.n, (1000::HUGEINT * cuts.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.p[1:cuts.k], ' ') AND x.m = cuts.k
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.p[cuts.k + 1:cuts.m], ' ') AND y.m = cuts.m - cuts.k
  JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

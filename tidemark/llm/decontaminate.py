"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's windows.

Benchmark items and documents are normalised alike: A-Z lower-cased, words are
runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  A window is 13 consecutive words of an
item (an item with fewer words is one window).  The distinct windows become the
patterns of an automaton; each document is normalised once, scanned once, and
every match is mapped back to word numbers and to offsets of the original text.

The windows are numbered by Spark and dealt into blocks of about ``block_chars``
characters by the hash of their text.  An automaton takes some 45 bytes a character, so a
worker holds at most one of about 90 MB and the texts of one round, whatever the size of
the benchmark.  A benchmark of one block has its automaton built once in each worker.  A
larger one is still one pass over the documents: a task takes ``round_chars`` of texts at a
time and runs every block's automaton over them (the stated query set against all rows).
The driver passes on one block at a time and never sees an item: matches are numbers of
windows, and the items behind them are joined by Spark.

Defined results: a null text has no words and is not contaminated; a null
``item_id`` marks words like any other item and is named ``null``; repeated rows
stay; an empty benchmark leaves every document clean; adjoining and overlapping hits are
one run.
"""

from __future__ import annotations

import re
import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, stage

WIDTH = 13
#: ASCII letters and digits stay (upper case lowered), other ASCII becomes a space, bytes of other letters stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_CHARS = 2_000_000
ROUND_CHARS = 16_000_000


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The distinct windows as (``id``, ``window``: words joined by a space, ``n`` words), and (``id``, ``item``)."""

    def make():
        def windows(text: str) -> list[dict]:
            w = words(text)
            got = {b" ".join(w[i : i + width]): min(width, len(w)) for i in range(max(1, len(w) - width + 1))} if w else {}
            return [{"window": k.decode("utf-8", "surrogatepass"), "n": n} for k, n in got.items()]

        return lambda texts: {"windows": [windows(t) for t in texts]}

    entry = pa.struct([("window", pa.string()), ("n", pa.int64())])
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text"))
    each = stage(map_texts(named, make, [("windows", pa.list_(entry))]).select("item", F.explode("windows").alias("w")).select("item", "w.window", "w.n").distinct(), "item-windows")
    windows = stage(each.select("window", "n").distinct().withColumn("id", F.monotonically_increasing_id()), "windows")
    items = each.join(windows.select(F.col("window").alias("known"), "id"), F.col("window") == F.col("known")).select("id", "item")
    return windows, items


def _automaton(patterns: list[tuple[str, int, int]]):
    """An automaton whose matches give (number of the window, its words)."""
    tree = ahocorasick.Automaton()
    for window, n, k in patterns:
        # latin-1 keeps one character per byte, for patterns and texts alike
        tree.add_word(" " + window.encode("utf-8", "surrogatepass").decode("latin-1") + " ", (k, n))
    if patterns:
        tree.make_automaton()
    return tree


def _line(text: str) -> bytes:
    w = words(text)
    return b" " + b" ".join(w) + b" " if w else b""


def find_matches(docs: DataFrame, blocks: list, text: str = "text", round_chars: int = ROUND_CHARS) -> DataFrame:
    """Scan every whole text once: ``n_words``, ``hits`` as word runs [first, last) with
    their offsets in the original text, and the numbers of the ``windows`` that occur.

    ``blocks``: broadcast lists of (window, words, number).
    """
    run = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def make():
        def tree_of(block):
            if len(blocks) > 1:
                tree = _automaton(block.value)
                block.__dict__.pop("_value", None)  # the next block takes its place
                return tree
            # kept with the broadcast value, for the worker's next tasks
            if "tree_" not in block.__dict__:
                block.__dict__["tree_"] = _automaton(block.value)
            return block.__dict__["tree_"]

        def scan_round(texts: list[str]) -> list[tuple[int, list[dict], list[int]]]:
            lines = [_line(t) for t in texts]
            spans: list[list[tuple[int, int]]] = [[] for _ in lines]
            known: list[set[int]] = [set() for _ in lines]
            for block in blocks:
                tree = tree_of(block)
                if not len(tree):
                    continue
                for i, line in enumerate(lines):
                    if not line:
                        continue
                    found = list(tree.iter(line.decode("latin-1")))
                    if found:
                        # the pattern's closing space ends word k, where k spaces come before it after the first
                        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                        for end, (k, n) in found:
                            last = int(np.searchsorted(spaces, end))
                            spans[i].append((last - n, last))
                            known[i].add(k)
                del tree
            return [(max(0, line.count(b" ") - 1), _runs(t, s), sorted(k)) for t, line, s, k in zip(texts, lines, spans, known)]

        def go(texts: list[str]) -> dict[str, list]:
            got, lo = [], 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= round_chars:
                    size += len(texts[hi])
                    hi += 1
                got += scan_round(texts[lo:hi])
                lo = hi
            return {"n_words": [g[0] for g in got], "hits": [g[1] for g in got], "windows": [g[2] for g in got]}

        return go

    return map_texts(docs, make, [("n_words", pa.int64()), ("hits", pa.list_(run)), ("windows", pa.list_(pa.int64()))], text, 1024 if len(blocks) == 1 else 10_000)


def _runs(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    """Joined word runs with their offsets in the text."""
    if not spans:
        return []
    spans.sort()
    merged = [list(spans[0])]
    for a, b in spans[1:]:
        if a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    at = [m.span() for m in _RAW_WORD.finditer(text)]
    return [{"first": a, "last": b, "start": at[a][0], "end": at[b - 1][1]} for a, b in merged]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_chars: int = BLOCK_CHARS, carry: tuple[str, ...] = ("doc_id",), with_items: bool = True, round_chars: int = ROUND_CHARS
) -> DataFrame:
    """``carry`` columns of every document, plus ``n_words``, ``n_hit``, ``hits``, ``contaminated`` (a hit word,
    and hits are at least a twentieth of the words) and, if asked for, ``items`` (sorted as text).

    ``carry`` may name ``text`` to keep the text in the result.
    """
    windows, items = item_windows(benchmark, width)
    chars = windows.agg(F.coalesce(F.sum(F.length("window")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(chars) // block_chars))
    sc = docs.sparkSession.sparkContext
    dealt = [windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b) for b in range(blocks)]
    shared = [sc.broadcast([(r.window, r.n, r.id) for r in part.select("window", "n", "id").toLocalIterator()]) for part in dealt]
    rows = docs.select(*[F.col(c) for c in carry], F.col("text").cast("string").alias("scan_text"))
    out = find_matches(rows, shared, "scan_text", round_chars)
    out = out.withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"]))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return _with_items(out, items) if with_items else out.drop("windows")


def _with_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` in place of the windows' numbers; only rows with hits are joined."""
    rows = stage(found.withColumn("hit_row", F.monotonically_increasing_id()), "matches")
    hit = F.size("windows") > 0
    each = rows.where(hit).select("hit_row", F.explode("windows").alias("window"))
    named = each.join(items, F.col("window") == F.col("id")).select(F.col("hit_row").alias("named_row"), "item").distinct()
    named = named.groupBy("named_row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    some = rows.where(hit).join(named, F.col("hit_row") == F.col("named_row"), "left").drop("named_row")
    none = rows.where(~hit).withColumn("items", F.expr("cast(array() as array<string>)"))
    return some.unionByName(none).drop("windows", "hit_row")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )

import hashlib
import random
import re

import pytest
from helpers import awkward_docs, clashing, frame, lower, prose, rows_of

from tidemark.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items, width=13):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add("null" if i is None else str(i))
    lengths = {len(k) for k in windows}
    out = []
    for r in rows:
        w = WORD.findall(lower(r[1]))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= got
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture()
def tables():
    rng = random.Random(4)
    items = [(k, prose(rng, rng.choice([3, 12, 13, 14, 40]), 30)) for k in range(12)]
    items += [(3, items[3][1]), (20, items[5][1] + " tail"), (21, None), (22, ""), (23, "?!"), (None, prose(rng, 15)), (24, "X"), (25, "Ünïcode Größe " * 8)]
    rows = awkward_docs()
    for k in range(60):
        i, j = rng.choice(items), rng.choice(items)
        rows.append((300 + k, prose(rng, rng.randrange(30), 30) + "... " + (i[1] or "").upper() + ",\n" + " ".join((j[1] or "").split()[:14]) + " " + prose(rng, rng.randrange(300)), "en", "s", 1))
    return rows, items


def test_matches_brute_force(spark, tables):
    rows, items = tables
    docs = clashing(frame(spark, rows), "n_words", "hits", "items", "window")
    bench = clashing(frame(spark, items, "item_id bigint, text string"), "window", "n", "item")
    assert rows_of(dec.digest(dec.decontaminate(docs, bench))) == brute(rows, items)


def test_blocks_give_the_same(spark, tables):
    rows, items = tables
    docs, bench = frame(spark, rows), frame(spark, items, "item_id bigint, text string")
    whole, parts = dec.decontaminate(docs, bench), dec.decontaminate(docs, bench, block_chars=2000, round_chars=5000)
    assert rows_of(dec.digest(parts)) == brute(rows, items)
    columns = ["doc_id", "n_words", "n_hit", "hits", "items", "contaminated"]
    assert rows_of(parts.select(columns)) == rows_of(whole.select(columns))
    assert rows_of(dec.decontaminate(docs, bench, with_items=False).select("doc_id", "hits")) == rows_of(whole.select("doc_id", "hits"))


def test_one_window_of_very_many_items(spark):
    text = " ".join(f"w{k}" for k in range(13))
    items = spark.range(100_000).selectExpr("id AS item_id", f"'{text}' AS text")
    docs = frame(spark, [(k, f"{text} and {text}" if k % 2 else "clean", None, None, None) for k in range(6)])
    got = {r.doc_id: r for r in dec.decontaminate(docs, items).collect()}
    assert got[1]["items"] == sorted(map(str, range(100_000))) and got[0]["items"] == [] and got[1].n_hit == 26


def test_offsets_point_into_the_original(spark):
    item = "One two, three four five six seven eight nine ten eleven twelve thirteen"
    text = "Séy: \"" + item.upper().replace(" ", "  ") + "\" é"
    r = dec.decontaminate(frame(spark, [(1, text, None, None, None)]), frame(spark, [(7, item)], "item_id bigint, text string")).first()
    span = r.hits[0]
    assert text[span.start : span.end] == item.upper().replace(" ", "  ")
    assert (r.n_hit, r["items"], r.contaminated) == (13, ["7"], True)


def test_empty_tables(spark, tables):
    rows, items = tables
    docs, bench = frame(spark, rows), frame(spark, items, "item_id bigint, text string")
    assert dec.digest(dec.decontaminate(docs.limit(0), bench)).collect() == []
    assert rows_of(dec.digest(dec.decontaminate(docs, bench.limit(0)))) == brute(rows, [])

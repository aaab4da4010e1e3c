"""Phrase collocations against plain Python counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import phrases
from tests.llm.helpers import awkward_docs, clashing, frame, lower

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            f.update((lang, w[i : i + m]) for i in range(len(w)) for m in range(1, 6) if i + m <= len(w))
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    dropped = {(g, p[i : i + m]) for (g, p), v in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * v >= 100 * f[g, p[i : i + m]]}
    out = {}
    for (g, p), a in cand.items():
        if (g, p) in dropped:
            continue
        score, k = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(g, []).append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return sorted((g, i, p.decode(), -a, x, y, n[g], -s) for g, got in out.items() for i, (s, a, p, x, y) in enumerate(sorted(got)[:top], 1))


def corpus(seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "a", "été", "b-c", "中", "x\0y", "x\1", "x", "x\1\2", "\x1c", "no break", "Z"]
    rows = list(awkward_docs())
    for i in range(60):
        text = "".join(rng.choice(words[: 4 + i % 12]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", " ! ", "?", "\r\n", "\x0b"]) for _ in range(150))
        rows.append((500 + i, text, rng.choice(["en", "de", None, "und", ""]), "s", 1))
    rows += [(900, "same same same same same same same " * 30, "en", "s", 1), (901, ". , ;:!?\n\n", "fr", "s", 1), (902, "word " * 400, "es", None, None)]
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("options", [{}, {"chunk_words": 50, "group_leaves": 20, "sketch": 1 << 15}, {"chunk_words": 700, "group_leaves": 3}])
def test_equals_brute_force(spark, options):
    rows = corpus()
    df = clashing(frame(spark, rows, SCHEMA).repartition(3), "phrase", "leaf", "total", "prefix", "n", "words")
    assert rows_of(phrases.collocations(df, least=8, top=40, **options)) == brute(rows, 8, 40)


def test_coarse_sketch_costs_leaves_but_no_counts(spark):
    rows = corpus(4)
    df = frame(spark, rows, SCHEMA)
    fine = rows_of(phrases.phrase_counts(df, least=5)[0])
    bitmap = np.full(phrases.SLICE // 8, 255, np.uint8)
    every = phrases.leaves(phrases.texts_of(df), bitmap, phrases.SLICE)
    pruned = phrases.leaves(phrases.texts_of(df), phrases.frequent_buckets(phrases.texts_of(df), 1 << 16, 5, 1000), 1 << 16)
    assert pruned.count() < every.count()
    was, phrases.HELD_LEAVES = phrases.HELD_LEAVES, 50
    try:  # many groups, and tasks that hold few leaves
        some = phrases.leaves(phrases.texts_of(df), bitmap, phrases.SLICE, chunk_words=300, groups=7)
        assert rows_of(some) == rows_of(every)
    finally:
        phrases.HELD_LEAVES = was
    assert every.agg({"total": "sum"}).first() == pruned.agg({"total": "sum"}).first()
    assert fine == rows_of(phrases.phrase_counts(df, least=5, sketch=phrases.SLICE, group_leaves=10)[0])


def test_products_beyond_64_bits_and_ties(spark):
    # the smaller first part wins where both cuts score alike; counts and products are exact
    counts = spark.createDataFrame([("en", "a", 1, 3 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 10**12 + 1)], "lang string, phrase string, words int, n bigint")
    totals = spark.createDataFrame([("en", 9 * 10**12)], "lang string, n bigint")
    was = phrases.phrase_counts
    phrases.phrase_counts = lambda *a, **k: (counts, totals)
    try:
        got = rows_of(phrases.collocations(counts))
    finally:
        phrases.phrase_counts = was
    a, n = 10**12 + 1, 9 * 10**12
    assert got == [("en", 1, "a b", a, 3 * 10**12, 3 * 10**12, n, 1000 * a * n // (3 * 10**12) ** 2)]


def test_empty_table(spark):
    assert rows_of(phrases.collocations(frame(spark, [], SCHEMA))) == []
    assert rows_of(phrases.collocations(frame(spark, [(1, None, None, None, None)], SCHEMA), least=1)) == []

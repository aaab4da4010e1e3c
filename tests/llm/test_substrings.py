import random

import numpy as np
import pytest
from helpers import awkward_docs, clashing, frame, prose, rows_of

from tidemark.llm import substrings as sub


def cases(seed=6):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (49, 50, 51, 80, 200)]
    rows = awkward_docs()
    for k in range(80):
        parts = [prose(rng, rng.randrange(60)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((rng.randrange(200, 260), rng.choice([" ", "\n", "\t "]).join(parts), "en", "x", 0))
    rows.append((400, "the " * 500, "en", "x", 0))
    rows.append((401, "the " * 70, "en", "x", 0))
    return rows


def want(rows):
    return sorted(sub.brute([(r[0], r[1]) for r in rows]), key=repr)


def test_awkward_rows_match_brute_force(spark):
    rows = cases()
    docs = clashing(frame(spark, rows), "text_key", "stretches", "prefix").repartition(3)
    assert rows_of(sub.digest(sub.remove_repeats(docs))) == want(rows)


@pytest.mark.parametrize("group_windows", [30, 4_000_000])
def test_over_full_groups_and_rounds(spark, monkeypatch, group_windows):
    monkeypatch.setattr(sub, "CHUNK_WORDS", 300)
    monkeypatch.setattr(sub, "FLUSH", 100)
    monkeypatch.setattr(sub, "PIECE", 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = cases(8)
        got = rows_of(sub.digest(sub.remove_repeats(frame(spark, rows).repartition(4), group_windows=group_windows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want(rows)


def test_empty_table(spark):
    assert sub.digest(sub.remove_repeats(frame(spark, []))).collect() == []


def test_run_hashes_depend_on_the_run_alone():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for width in (1, 7, 8, 50, 64):
        h = sub.run_hashes(np.concatenate((w, w[100:300])), width)
        assert len(h) == 600 - width + 1
        assert (h[400 : 600 - width + 1] == h[100 : 300 - width + 1]).all()
        assert len(np.unique(h[: 400 - width + 1])) == 400 - width + 1


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = "  ab cd\tabc\x0b\x0c ä\nab cd " + "z" * 500 + " end"
    whole = sub.word_hashes(text.encode())
    monkeypatch.setattr(sub, "PIECE", 5)
    assert (sub.word_hashes(text.encode()) == whole).all()
    assert whole[0] == whole[4] and len(np.unique(whole)) == len(whole) - 2


def test_sliding_min():
    v = np.array([5, 3, 9, 1, 7, 8, 2], np.uint64)
    assert sub.sliding_min(v, 3).tolist() == [3, 1, 1, 1, 2]
    assert sub.sliding_min(v, 1).tolist() == v.tolist()

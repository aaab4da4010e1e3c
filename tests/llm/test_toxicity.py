import random
import zlib

import numpy as np
from helpers import awkward_docs, clashing, frame, prose, rows_of

from tidemark.llm import toxicity as tox

LABELS = "doc_id bigint, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randrange(5, 300)).split()
        bad = rng.random() < 0.3
        if bad:
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = rng.choice(["Rotten!", "VILE", "scoundrel,", "zarg" + rng.choice(["on", "ed", "ing", "us"])])
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = tox.initial(rng)
    words = [b"one", b"two,", b"three", b"four"]
    x, _ = tox.embed(p, words)
    g = tox.gates(p, x)
    ids = np.array([[1, 2, 3, 0, 0], [4, 1, 1, 2, 3]])
    y = np.array([1.0, 0.0], np.float32)
    loss = lambda q, gg: float((np.logaddexp(0, (z := tox.forward(q, gg, ids).astype(np.float64))) - y * z).sum())
    logit, kept = tox.forward(p, g, ids, keep=True)
    grad, dg = tox.backward(p, g, ids, kept, tox.sigmoid(logit) - y)
    for name in ("att", "out", "bias", "u"):
        for at in [tuple(rng.integers(0, s) for s in p[name].shape) for _ in range(5)]:
            q = {**p, name: p[name].copy()}
            q[name][at] += 1e-2
            up = loss(q, g)
            q[name][at] -= 2e-2
            assert abs((up - loss(q, g)) / 2e-2 - grad[name][at]) < 2e-3
    for at in [(1, 0, 3), (2, 1, 10), (4, 0, 20)]:
        h = g.copy()
        h[at] += 1e-2
        up = loss(p, h)
        h[at] -= 2e-2
        assert abs((up - loss(p, h)) / 2e-2 - dg[at]) < 2e-3


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 72, 73, 1000):
        starts = list(tox.window_starts(n))
        seen = {i for s in starts for i in range(s, min(n, s + tox.LENGTH))}
        assert seen == set(range(n)) and all(b - a <= tox.STRIDE for a, b in zip(starts, starts[1:]))


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, marks = frame(spark, rows), frame(spark, labels, LABELS)
    got = tox.digest(tox.toxicity(docs, marks)).collect()
    truth = {i: t for i, _, t in labels}
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {i for i in truth if held(i)}
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows, labels = corpus(300)
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    other = [(i, t, "xx", "yy", 9) for i, t, *_ in rows]
    one = tox.digest(tox.toxicity(frame(spark, rows), frame(spark, labels, LABELS), steps=40))
    two = tox.digest(tox.toxicity(frame(spark, other), frame(spark, flipped, LABELS), steps=40))
    assert rows_of(one) == rows_of(two)


def test_awkward_rows(spark):
    rows, labels = corpus(60)
    data = awkward_docs() + [(1000 + i, *r) for i, *r in rows]
    marks = [(1000 + i, q, t) for i, q, t in labels] + [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0), (99_999, 0, 1)]
    docs = clashing(frame(spark, data), "score", "predicted", "toxic", "held_out")
    got = tox.digest(tox.toxicity(docs, clashing(frame(spark, marks, LABELS), "text", "score"), steps=20)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got if r.doc_id is not None) == sorted((False, r[0]) for r in data if r[0] is not None)
    assert all(r.held_out for r in got if r.doc_id is None)
    empty = {round(r.score, 6) for r in got if r.doc_id in (4, 5, 6)}
    assert len(empty) == 1


def test_without_both_classes(spark):
    rows, labels = corpus(20)
    docs = frame(spark, rows)
    none = tox.toxicity(docs, frame(spark, [], LABELS)).collect()
    assert {r.score for r in none} == {0.0}
    same = tox.toxicity(docs, frame(spark, [(i, 1, 1) for i, _, _ in labels], LABELS)).collect()
    assert {r.score for r in same} == {1.0}
    assert tox.toxicity(docs.limit(0), frame(spark, labels, LABELS)).collect() == []


def test_best_cut():
    s, y = np.array([-3.0, -2.0, -1.9, 1.0, 2.0, 2.1]), np.array([0, 0, 0, 1, 1, 1])
    assert tox.best_cut(s, y) == (-1.9 + 1.0) / 2

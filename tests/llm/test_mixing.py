import random
from collections import Counter

import pytest
from helpers import SPACE_WORDS, awkward_docs, clashing, frame, prose, rows_of
from pyspark.sql import functions as F

from tidemark.llm import mixing


def targets(sizes, cap=3):
    """The contract's rounds: stop at the cap, share the excess by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in stopped]
        rest = total - sum(cap * sizes[s] for s in stopped)
        share = rest / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if share * weight[s] > cap * sizes[s] + 1e-9}
        if not above:
            return {s: cap * sizes[s] if s in stopped else share * weight[s] for s in names}
        stopped |= above


def check(rows, got, slack):
    size = lambda t: len(SPACE_WORDS.findall(t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert sorted((r.size for r in got)) == sorted(size(r[1]) for r in rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack(sizes[s], want[s]), (s, taken[s], want[s])


def corpus(seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(600):
        source = rng.choice(["web"] * 30 + ["a", "B", "", "ü", None, "c", "d"])
        rows.append((k, prose(rng, min(2000, int(rng.paretovariate(0.7) * 5))), "en", source, 0))
    return rows


def test_sources_come_near_their_targets(spark):
    rows = corpus()
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    check(rows, got, lambda size, want: 0.01 * want + 10)
    assert rows_of(mixing.digest(mixing.mix(docs.repartition(5)))) == rows_of(mixing.digest(mixing.mix(docs)))


def test_awkward_rows(spark):
    rows = awkward_docs()
    docs = clashing(frame(spark, rows), "size", "taken", "target", "salt", "source_key", "n")
    # a source of a single long document can only be taken whole
    check(rows, mixing.mix(docs).collect(), lambda size, want: 0.75 * size + 10)


def test_empty_tables_and_empty_texts(spark):
    assert mixing.digest(mixing.mix(frame(spark, []))).collect() == []
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (2, "", "en", None, 0)]
    got = mixing.digest(mixing.mix(frame(spark, rows))).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 10, "b": 1, "c": 2000, "d": 0, "e": 5, None: 3}
    t = mixing.source_targets(spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, words bigint"))
    want = targets(sizes)
    for r in t.collect():
        assert r.target == pytest.approx(want[r.source])


def test_newton_meets_the_targets(spark):
    rng = random.Random(9)
    classes = [(s, size, rng.randrange(1, 9)) for s in "abc" for size in sorted(rng.sample(range(1, 3000), 40))]
    frame_ = spark.createDataFrame(classes, "source_key string, size bigint, n bigint")
    total = Counter()
    for s, size, n in classes:
        total[s] += size * n
    goal = {"a": 0.2 * total["a"], "b": 2.7 * total["b"], "c": 1.0 * total["c"]}
    t = spark.createDataFrame([(s, total[s], goal[s]) for s in "abc"], "source_key string, source_size bigint, target double")
    tilt = {r.source_key: r for r in mixing.solve_tilt(frame_, t).collect()}
    import math

    for s in "abc":
        words = sum(n * size * min(3.0, math.exp(tilt[s].tilt * size / tilt[s].unit)) for k, size, n in classes if k == s)
        assert words == pytest.approx(goal[s], rel=1e-5)
    assert tilt["a"].tilt < 0 < tilt["b"].tilt


def test_no_python_in_the_plan(spark):
    plan = mixing.digest(mixing.mix(frame(spark, corpus()[:50])))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_count_words(spark):
    texts = ["", " ", "a", " a b ", "\ta\x0bb\x0cc\r\nd", "no break", "x " * 50_000]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").select("k", mixing.count_words(F.col("text")).alias("n")).collect()
    assert [r.n for r in sorted(got)] == [len(SPACE_WORDS.findall(t)) for t in texts]

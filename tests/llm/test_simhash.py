import random

import numpy as np
import xxhash
from helpers import SPACE_WORDS, awkward_docs, clashing, frame, lower, rows_of

from tidemark.llm import simhash
from tidemark.llm.simhash import digest, keep_one, majority, near_links, simhash_components


def fingerprint(text, width=3):
    w = SPACE_WORDS.findall(lower(text))
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, bits=3):
    """Smallest value reachable over links of at most ``bits`` bits."""
    values = sorted(set(values))
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {values[i]: values[find(i)] for i in range(len(values))}


def expected(rows, bits=3):
    prints = [fingerprint(r[1]) for r in rows]
    root = roots(prints, bits)
    first = {}
    for r, f in zip(rows, prints):
        if r[0] is not None:
            first[root[f]] = min(r[0], first.get(root[f], r[0]))
    return sorted(((r[0], f"{f:016x}", first.get(root[f])) for r, f in zip(rows, prints)), key=repr)


def test_awkward_rows_match_brute_force(spark):
    rows = awkward_docs()
    docs = clashing(frame(spark, rows), "fp", "component_id", "root", "text_key")
    got = rows_of(digest(simhash_components(docs)))
    assert got == expected(rows)
    assert rows_of(digest(simhash_components(docs, parts=4))) == expected(rows)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert digest(simhash_components(docs)).collect() == []
    assert keep_one(docs).collect() == []


def test_majority_counts_past_a_byte():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 1001, dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert majority(h) == want
    assert majority(h[:0]) == 0


def clusters(seed):
    """Dense clusters around a few centres, and scattered points."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(200)]
    for centre in out[:4]:
        for _ in range(150):
            v = centre
            for _ in range(rng.randrange(1, 6)):
                v ^= 1 << rng.randrange(64)
            out.append(v)
    return list(dict.fromkeys(out))


def test_links_keep_all_components_with_split_anchors(spark):
    values = clusters(3)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(3)
    want = roots(values)
    for parts, chunk in ((2, 4096), (2, 7), (4, 50)):
        links = near_links(fps, 3, parts, chunk)
        pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
        got = simhash.connected_components(links).collect()
        found = {r.node % (1 << 64): r.root % (1 << 64) for r in got}
        groups = {}
        for v in values:
            groups.setdefault(found.get(v, v), set()).add(v)
        expect = {}
        for v in values:
            expect.setdefault(want[v], set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))
        # a forest for each anchor, not the pairs of a cluster
        assert len(pairs) < 40 * len(values)


def test_groups_stream_over_batches(spark):
    values = clusters(5)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
        got = simhash.connected_components(near_links(fps)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = roots(values)
    sizes = lambda m: sorted(np.unique(list(m), return_counts=True)[1].tolist())
    assert sizes(r.root for r in got) == [n for n in sizes(want.values()) if n > 1]


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.connected_components(links).collect()}
    assert got == {k: 0 for k in range(301)}


def test_keep_one(spark):
    rows = awkward_docs()
    kept = keep_one(frame(spark, rows)).collect()
    component = {(r[0], f): c for (r, f, c) in ((r, fingerprint(r[1]), None) for r in rows)}
    root = roots([f for _, f in component])
    best = {}
    for (i, f) in component:
        best.setdefault(root[f], []).append((i is None, i if i is not None else 0))
    assert sorted((k.doc_id is None, k.doc_id or 0) for k in kept) == sorted(min(v) for v in best.values())
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}

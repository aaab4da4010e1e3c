"""Conversation repair against a memoised search over (cost, audit)."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tidemark.llm import conversations as cv
from tests.llm.helpers import clashing, frame

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_repair(rows):
    """rows: (role, text, fault) -> (cost, audit, repaired) by trying all edits."""
    n = len(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, state, added):
        out = []
        if i == n and state in ("", "a"):
            out.append((0, "", ()))
        if added < 3:
            for role in ("user", "assistant"):
                if role[0] in step[state]:
                    c, a, r = best(i, role[0], added + 1)
                    out.append((c + 5, "I" + a, ((role, ""), *r)))
        if i < n:
            role, text, fault = rows[i]
            c, a, r = best(i + 1, state, 0)
            out.append((c + 2, "D" + a, r))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                if role[:1] in step[state]:
                    c, a, r = best(i + 1, role[0], 0)
                    out.append((c + more, "K" + a, ((role, text), *r)))
                for new in ("user", "assistant"):
                    if new[0] in step[state]:
                        c, a, r = best(i + 1, new[0], 0)
                        out.append((c + 1 + more, "R" + a, ((new, text), *r)))
        return min(out, key=lambda x: (x[0], x[1].encode())) if out else (1 << 30, "", ())

    return best(0, "", 0)


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        here = convs.setdefault(conv, [])
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        here += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = []
    for conv, here in convs.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, marked = set(), []
        for _, role, text in here:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            marked.append((role, text, "b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "."))
            seen.add((role, text))
        count = {f: sum(m[2] == f for m in marked) for f in "bdt"}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, fixed = brute_repair(tuple(marked))
        text = "\n".join(f"{r}:{t}" for r, t in fixed)
        out.append((conv, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_up(seed=5, convs=150):
    rng = random.Random(seed)
    out = []
    for c in range(convs):
        turn = rng.randrange(-2, 5)
        for _ in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unknown", "User", None])
            text = rng.choice(["Hello there.", "No end", "", " \t\r\n\x0b\x0c", None, "Why? ", "a.b!c", "é", " ", f"words {rng.randrange(5)}."])
            out.append((c, turn, role, text))
            turn += rng.choice([0, 1, 1, 1, 3])
    out += [(None, None, "user", "Hi."), (None, None, None, None), (None, 4, "assistant", "Yes."), (900, None, "user", "x"), (901, 2**62, "user", "x."), (901, -(2**60), "user", "x.")]
    out += [(902, 7, "user", "Same.")] * 6 + [(903, k, "user" if k % 2 == 0 else "assistant", f"Turn {k % 9}." if k % 7 else "cut") for k in range(120)]
    # turns that are all dropped leave the conversation
    out += [(c, 0, "user", "Gone.") for c in range(1000, 1060)]
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = made_up()
    df = clashing(frame(spark, rows, SCHEMA).repartition(5), "chunk", "copies", "faults", "entry", "cost", "row")
    want = brute(rows)
    assert any(w[7] == "" for w in want) and any("R" in w[7] for w in want) and any("K" in w[7] for w in want)
    assert rows_of(cv.repair_conversations(cv.damage(df), "copies")) == want


@pytest.mark.parametrize("chunk_rows", [1, 3, 16])
def test_chunks_of_a_conversation_equal_the_whole(spark, chunk_rows):
    rows = made_up(9, 40)
    got = rows_of(cv.repair_conversations(cv.damage(frame(spark, rows, SCHEMA)), "copies", chunk_rows=chunk_rows))
    assert got == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, k // 2, ("user", "assistant", "system", "x")[(k * k) % 4], f"Text {k % 500}{'.' if k % 3 else ''}") for k in range(6000)]
    df = cv.damage(frame(spark, rows, SCHEMA))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        got = rows_of(cv.repair_conversations(df, "copies", chunk_rows=100))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert got == rows_of(cv.repair_conversations(df, "copies", chunk_rows=10**6, chunk_chars=10**9))
    turns = cv.repaired_turns(df, "copies", chunk_rows=100).orderBy("chunk", "place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in turns))
    text = "\n".join(f"{t.role}:{t.text}" for t in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == got[0][-1]


def test_empty_table_text_ids_and_undamaged_turns(spark):
    assert rows_of(cv.repair_conversations(cv.damage(frame(spark, [], SCHEMA)), "copies")) == []
    ids = clashing(frame(spark, [("a", "1", "system", "Be kind."), ("a", "2", "user", "Hi."), ("a", "x", "user", "Hi.")], "conv_id string, turn string, role string, text string"), "copies", "row")
    # the turn without a number comes first, the system turn becomes the assistant's, the second of two equal turns goes
    assert [r[1:8] for r in rows_of(cv.repair_conversations(ids))] == [(0, 0, 1, 0, 1, 3, "KRD")]


def test_long_texts_and_random_graphs():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 5, 9):
        for _ in range(60):
            faults, roles = rng.choice(list("..bdt"), size), rng.choice(["s", "u", "a", "u", "a", "x"], size)
            codes = cv._codes("".join(faults), list(roles))
            cost, audits, _ = cv.solve([codes[0]], [codes[1]], cv.FINAL[None], np.ones(1, bool))
            want = brute_repair(tuple((str(r), "text", str(f)) for r, f in zip(roles, faults)))
            assert (cost[0, 0], audits[0][0]) == want[:2]

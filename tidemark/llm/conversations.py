"""Conversation structure repair by prefix-doubling path ranking.

A conversation is a sequence of turns whose role initials should read ``(s?(ua)+)?``.
Each turn may be kept (cost 0), given the role user or assistant (1) or deleted (2,
required for blank and repeated turns); an empty turn may be put anywhere (5); a
truncated turn that stays adds 5.  The repair is the cheapest list of edits, and of
those the one whose initials (K, R, D, I in order, the *audit*) are ASCII-least.

1. Cost DP.  A node is (turns done, state of the pattern); from the end backwards each
   node gets the cost of its cheapest rest.  Arcs on a cheapest rest are *optimal*.
2. Path ranking.  Nodes are ranked by the least audit of one letter that leads out of
   them over optimal arcs; then, with the node that many letters ahead known (a doubled
   pointer), by audits of 2, 4, 8, ... letters: the rank of twice the length is the rank
   of the pair (own rank, rank of the node ahead).  With the last ranks each node takes the
   arc of least (letter, rank behind it).  An edit leads from a node to one node only, so
   a prefix of an audit has one end and the pointers are exact.
3. The audit is read from the start in steps that double, over the pointers.

All conversations of a batch are one graph in numpy.

Scale: turns are dealt by ranges of (conversation, turn, role, text, row), so one
conversation with a third of all rows is spread over many tasks; each task cuts its rows
into chunks of at most ``chunk_rows`` turns and ``chunk_chars`` characters.  Nearly all
conversations are one chunk and are solved where they are read.  For a conversation of
several chunks each chunk gives its 4 x 4 table of least costs from state to state, the
tables are chained backwards (a few numbers a chunk), each chunk is solved against the
costs behind it for all four states, and the chain forwards picks one.  Repeated turns
of such a conversation are found by a shuffle of 16-byte digests.  Only its SHA-256
passes its turns through one task, one by one: a digest of one text can't be split.

Defined results: turns are ordered by number, nulls first, and turns with one number by
role and text; a null role or text is one space; a role without the initial s, u or a (an
empty one too) can't be kept; turn numbers that aren't integers count as null; a
conversation without turns has zeros, an empty audit and the digest of nothing; a null
conversation is a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.ranking import range_partitions
from tidemark.llm.common import stage

CHUNK_ROWS, CHUNK_CHARS = 4096, 4_000_000
BLANKS = " \t\n\x0b\x0c\r"
#: States of the pattern: nothing yet, after s, after u, after a.  An added or renamed turn leads to NEXT.
STATES, START = 4, 0
NEXT = np.array([2, 2, 3, 2])
#: State after a kept turn with the initial s, u, a or another one; -1: not allowed.
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = frozenset(("su", "ua", "au"))
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 40
LETTERS = "\0DIKR"
#: Least costs behind the last turn: nothing, or whole user-assistant pairs.
FINAL = np.array([0, 2 * INSERT, INSERT, 0])
CELLS = 40_000


# ---- the graph --------------------------------------------------------------


class Graph:
    """Cost DP and path ranking of several chunks at once.

    ``faults`` and ``initials`` hold one array for each chunk: 0 sound, 1 to be deleted, 2
    truncated; and 0 to 3 for s, u, a, other.  ``behind`` is the cost behind each chunk by state;
    ``last`` says which chunks end their conversation.
    """

    def __init__(self, faults: list[np.ndarray], initials: list[np.ndarray], behind: np.ndarray, last: np.ndarray):
        m, self.n = len(faults), np.array([len(f) for f in faults])
        width = int(self.n.max(initial=0))
        self.width = width + 1
        # chunks are aligned at their ends
        fault, initial = np.zeros((m, width), np.int64), np.zeros((m, width), np.int64)
        for i, (f, t) in enumerate(zip(faults, initials)):
            fault[i, width - len(f) :], initial[i, width - len(f) :] = f, t
        self.cost = np.full((m, width + 1, STATES), FAR, np.int64)
        # by node: which of the letters D, I, K, R lead out of it at least cost, and where to
        best = np.zeros((m, width + 1, STATES, 4), bool)
        to = np.zeros((m, width + 1, STATES, 4), np.int64)
        node = np.arange(m * (width + 1) * STATES).reshape(m, width + 1, STATES)
        self.cost[:, width] = behind
        best[:, width, :, 1] = last[:, None] & (behind == INSERT + behind[:, NEXT])
        to[:, width, :, 1] = node[:, width, NEXT]
        for at in range(width - 1, -1, -1):
            rest, f = self.cost[:, at + 1], fault[:, at, None]
            after = KEPT[:, initial[:, at]].T
            stay = np.where(f == 1, FAR, np.where(f == 2, TRUNCATED, 0))
            kept = np.where(after < 0, FAR, np.take_along_axis(rest, np.maximum(after, 0), 1) + stay)
            step = np.stack([rest + DELETE, np.full_like(rest, FAR), kept, rest[:, NEXT] + RENAME + stay], 2)
            here = step.min(2)
            # an added turn stays at the place; more than two of them lead back to a state
            for _ in range(2):
                here = np.minimum(here, INSERT + here[:, NEXT])
            here = np.minimum(here, FAR)
            step[:, :, 1] = INSERT + here[:, NEXT]
            self.cost[:, at] = here
            best[:, at] = (step == here[:, :, None]) & (here < FAR)[:, :, None]
            to[:, at, :, 0] = node[:, at + 1]
            to[:, at, :, 1] = node[:, at, NEXT]
            to[:, at, :, 2] = np.take_along_axis(node[:, at + 1], np.maximum(after, 0), 1)
            to[:, at, :, 3] = node[:, at + 1, NEXT]
        self._rank(best.reshape(-1, 4), to.reshape(-1, 4))

    def _rank(self, best: np.ndarray, to: np.ndarray) -> None:
        nodes = np.arange(len(best))
        ends = ~best.any(1)
        first = best.argmax(1)
        rank = np.where(ends, 0, first + 1)
        ahead = np.where(ends, nodes, to[nodes, first])
        while (ahead[ahead] != ahead).any():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[ahead], return_inverse=True)
            ahead = ahead[ahead]
        # the arc of least (letter, rank behind it)
        key = np.where(best, np.arange(4) * (int(rank.max(initial=0)) + 1) + rank[to], FAR)
        pick = key.argmin(1)
        self.letter = np.where(ends, 0, pick + 1)
        self.ahead = [np.where(ends, nodes, to[nodes, pick])]
        while (self.ahead[-1][self.ahead[-1]] != self.ahead[-1]).any():
            self.ahead.append(self.ahead[-1][self.ahead[-1]])

    def start_costs(self) -> np.ndarray:
        return self.cost[np.arange(len(self.n)), self.width - 1 - self.n]

    def audits(self, state: int) -> tuple[list[str], np.ndarray]:
        """Each chunk's audit from ``state``, and the state behind it."""
        path = ((np.arange(len(self.n)) * self.width + self.width - 1 - self.n) * STATES + state)[:, None]
        for ahead in self.ahead:
            path = np.concatenate((path, ahead[path]), 1)
        letters = self.letter[path]
        table = np.frombuffer(LETTERS.encode(), np.uint8)
        return [table[row[row > 0]].tobytes().decode() for row in letters], self.ahead[-1][path[:, -1]] % STATES


def solve(faults: list[np.ndarray], initials: list[np.ndarray], behind: np.ndarray, last: np.ndarray, states=(START,)) -> tuple[np.ndarray, list[list[str]], np.ndarray]:
    """Costs (chunk, state), and for each of ``states`` the audits and the states behind the chunks."""
    m = len(faults)
    costs, ends = np.zeros((m, STATES), np.int64), np.zeros((m, len(states)), np.int64)
    audits = [[""] * m for _ in states]
    sizes = np.array([len(f) for f in faults], np.int64)
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < m:
        # chunks of about one length go together
        hi = lo + 1
        while hi < m and sizes[order[hi]] <= 2 * sizes[order[lo]] + 4 and (hi + 1 - lo) * (sizes[order[hi]] + 1) <= CELLS:
            hi += 1
        some = order[lo:hi]
        g = Graph([faults[i] for i in some], [initials[i] for i in some], behind[some], last[some])
        costs[some] = g.start_costs()
        for k, state in enumerate(states):
            found, behind_state = g.audits(state)
            ends[some, k] = behind_state
            for i, audit in zip(some, found):
                audits[k][i] = audit
        lo = hi
    return costs, audits, ends


# ---- turns ------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn``, modulo 20: a ``copies`` column says how often a turn is there."""
    space = F.lit(" ")
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    what = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return turns.select(
        "conv_id",
        "turn",
        F.when(what == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(what == 1, F.lit("")).when(what == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(what == 0, 0).when(what == 3, 2).otherwise(1).alias("copies"),
    )


def _chunk_type(turns: DataFrame) -> StructType:
    rest = "chunk bigint, turns int, roles array<string>, texts array<string>, faults string, digests binary, first_turn bigint, last_turn bigint, n_turns bigint"
    return StructType([StructField("conv_id", turns.schema["conv_id"].dataType), *StructType.fromDDL(rest).fields])


def cut_chunks(turns: DataFrame, copies: str | None = None, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Conversations in chunks of consecutive turns, numbered in order; ``copies`` names a column that says how often a row counts.

    ``faults`` has a letter for each turn: b(lank), d(uplicate of a turn of the same chunk), t(runcated) or
    a full stop.  ``n_turns`` counts the chunk's distinct turn numbers.
    """
    space = F.lit(" ")
    times = F.col(copies).cast("int") if copies else F.lit(1)
    number = F.expr("try_cast(turn as bigint)")
    rows = turns.select("conv_id", number.alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), times.alias("copies"))
    keys = ["conv_id", "turn", "role", "text", "row"]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(range_partitions(turns), *keys).sortWithinPartitions(*keys)
    schema = _chunk_type(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        done: list[dict] = []
        cur: dict | None = None
        seen: set[bytes] = set()
        size = made = 0

        def new(conv):
            nonlocal size, made
            size, made = 0, made + 1
            seen.clear()
            return {"conv_id": conv, "chunk": part + made, "roles": [], "texts": [], "faults": [], "digests": [], "first_turn": None, "last_turn": None, "n_turns": 0}

        def out() -> pa.RecordBatch:
            cols = {n: [c[n] for c in done] for n in ("chunk", "roles", "texts", "first_turn", "last_turn", "n_turns")}
            cols["turns"] = [len(c["roles"]) for c in done]
            cols["faults"] = ["".join(c["faults"]) for c in done]
            cols["digests"] = [b"".join(c["digests"]) for c in done]
            cols["conv_id"] = [c["conv_id"] for c in done]
            kinds = {"chunk": pa.int64(), "turns": pa.int32(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "faults": pa.string(), "digests": pa.binary(), "first_turn": pa.int64(), "last_turn": pa.int64(), "n_turns": pa.int64()}
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], kinds.get(f.name, conv_type)) for f in schema.fields], names=schema.names)

        held = 0
        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, turn, role, text, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if cur is None or conv != cur["conv_id"]:
                    if cur is not None:
                        done.append(cur)
                        held += size
                    cur = new(conv)
                for _ in range(copies):
                    if len(cur["roles"]) >= chunk_rows or (size and size + len(text) > chunk_chars):
                        done.append(cur)
                        held += size
                        cur = new(conv)
                    key = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))
                    bare = text.rstrip(BLANKS)
                    cur["faults"].append("b" if not bare else "d" if key in seen else "." if bare[-1] in ".!?" else "t")
                    seen.add(key)
                    cur["digests"].append(key)
                    cur["roles"].append(role)
                    cur["texts"].append(text)
                    size += len(text) + len(role)
                    if turn is not None:
                        if cur["last_turn"] != turn:
                            cur["n_turns"] += 1
                        cur["last_turn"] = turn
                        if cur["first_turn"] is None:
                            cur["first_turn"] = turn
                if len(done) >= 2000 or held >= 8_000_000:
                    yield out()
                    held = 0
        if cur is not None:
            done.append(cur)
            yield out()

    return dealt.select("conv_id", "turn", "role", "text", "copies").mapInArrow(run, schema)


def _codes(faults: str, roles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([{".": 0, "t": 2}.get(f, 1) for f in faults], np.int64), np.array([INITIALS.get(r[:1], 3) for r in roles], np.int64)


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def _late_repeats(long: DataFrame) -> DataFrame:
    """(chunk, late): by chunk, the places of turns that an earlier chunk of the conversation has too."""
    each = long.where("turns > 0").select(
        "conv_id", "chunk", F.posexplode(F.expr("transform(sequence(0, turns - 1), i -> substring(digests, 16 * i + 1, 16))")).alias("place", "digest")
    )
    first = each.groupBy("conv_id", "digest").agg(F.min("chunk").alias("first"), F.max("chunk").alias("final")).where("first < final")
    first = first.select(F.col("conv_id").alias("c"), F.col("digest").alias("g"), "first")
    late = each.join(first, _same("conv_id", "c") & (F.col("digest") == F.col("g"))).where("chunk > first")
    return late.groupBy("chunk").agg(F.collect_set("place").alias("late"))


def _mark(faults: str, late) -> str:
    if late is None or not len(late):
        return faults
    out = list(faults)
    for i in late:
        if out[i] != "b":
            out[i] = "d"
    return "".join(out)


SOLVED = "entry int, cost bigint, audit string"


def solve_chunks(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks of conversations of one chunk, and of those of several, with ``entry`` (the pattern's state before the
    chunk), ``cost`` (from there to the end of the conversation) and ``audit``."""
    several = stage(chunks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c")), "long")
    short = chunks.join(several, _same("conv_id", "c"), "left_anti")
    long = stage(chunks.join(several, _same("conv_id", "c"), "left_semi"), "chunks")
    added = StructType.fromDDL(SOLVED).fields

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            codes = [_codes(f, r) for f, r in zip(batch.column(at["faults"]).to_pylist(), batch.column(at["roles"]).to_pylist())]
            m = len(codes)
            cost, audits, _ = solve([c[0] for c in codes], [c[1] for c in codes], np.tile(FINAL, (m, 1)), np.ones(m, bool))
            more = [pa.array(np.zeros(m, np.int32)), pa.array(cost[:, START]), pa.array(audits[0], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "entry", "cost", "audit"])

    short = short.mapInArrow(alone, StructType([*chunks.schema.fields, *added]))

    # conversations of several chunks: mark repeats, chain the cost tables back, solve, chain the states forward
    marked = long.join(_late_repeats(long), "chunk", "left")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, faults, roles, late, conv = (batch.column(i).to_pylist() for i in range(5))
            now = [_mark(f, x) for f, x in zip(faults, late)]
            codes = [_codes(f, r) for f, r in zip(now, roles)]
            m = len(codes)
            table = np.zeros((m, STATES, STATES), np.int64)
            for to in range(STATES):
                behind = np.full((m, STATES), FAR)
                behind[:, to] = 0
                table[:, :, to] = solve([c[0] for c in codes], [c[1] for c in codes], behind, np.zeros(m, bool))[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), pa.array(chunk), pa.array(now, pa.string()), batch.column(2), pa.array([t.ravel().tolist() for t in table], pa.list_(pa.int64()))], names=["conv_id", "chunk", "faults", "roles", "least"]
            )

    conv = [f for f in chunks.schema.fields if f.name == "conv_id"]
    costs = stage(
        marked.select("chunk", "faults", "roles", "late", "conv_id").mapInArrow(tables, StructType([*conv, *StructType.fromDDL("chunk bigint, faults string, roles array<string>, least array<bigint>").fields])), "costs"
    )

    def backwards(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ascending=False)
        behind, out = FINAL, []
        for chunk, least in zip(rows["chunk"], rows["least"]):
            out.append((chunk, behind.tolist(), len(out) == 0))
            # the last chunk alone may add turns behind its turns
            behind = np.minimum((np.asarray(least).reshape(STATES, STATES) + behind).min(1), FAR)
        return pd.DataFrame(out, columns=["chunk", "behind", "last"])

    chain = costs.select("conv_id", "chunk", "least").groupBy("conv_id").applyInPandas(backwards, "chunk bigint, behind array<bigint>, last boolean")

    def each_state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, faults, roles, behind, last = (batch.column(i).to_pylist() for i in range(5))
            codes = [_codes(f, r) for f, r in zip(faults, roles)]
            cost, audits, ends = solve([c[0] for c in codes], [c[1] for c in codes], np.array(behind, np.int64).reshape(-1, STATES), np.array(last, bool), range(STATES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(5), pa.array(chunk), pa.array(cost.tolist(), pa.list_(pa.int64())), pa.array(list(zip(*audits)), pa.list_(pa.string())), pa.array(ends.tolist(), pa.list_(pa.int64()))],
                names=["conv_id", "chunk", "costs", "audits", "ends"],
            )

    paths = stage(
        costs.join(chain, "chunk").select("chunk", "faults", "roles", "behind", "last", "conv_id").mapInArrow(
            each_state, StructType([*conv, *StructType.fromDDL("chunk bigint, costs array<bigint>, audits array<string>, ends array<bigint>").fields])
        ),
        "paths",
    )

    def forwards(rows: pd.DataFrame) -> pd.DataFrame:
        state, out = START, []
        for chunk, ends in sorted(zip(rows["chunk"], rows["ends"])):
            out.append((chunk, state))
            state = int(ends[state])
        return pd.DataFrame(out, columns=["chunk", "entry"])

    entry = paths.select("conv_id", "chunk", "ends").groupBy("conv_id").applyInPandas(forwards, "chunk bigint, entry int")
    picked = paths.join(entry, "chunk").select("chunk", "entry", F.expr("costs[entry]").alias("cost"), F.expr("audits[entry]").alias("audit"))
    now = costs.select("chunk", F.col("faults").alias("marked"))
    long = long.join(now, "chunk").withColumn("faults", F.col("marked")).join(picked, "chunk").select(*chunks.columns, "entry", "cost", "audit")
    return short, long


def replay(entry: int, audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each turn that is there after the repair."""
    state, i = entry, 0
    for edit in audit:
        new = ("user", "assistant", "user")[max(0, state - 1)]  # by what NEXT leads to
        if edit == "I":
            state = int(NEXT[state])
            yield edit, new, ""
            continue
        role, text = roles[i], texts[i]
        i += 1
        if edit == "D":
            continue
        if edit == "K":
            state = int(KEPT[state, INITIALS[role[0]]])
            yield edit, role, text
        else:
            state = int(NEXT[state])
            yield edit, new, text


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Sum:
    """Counts and digest of one conversation, chunk by chunk."""

    def __init__(self, conv):
        self.conv, self.audit, self.cost, self.faults = conv, [], 0, {"b": 0, "d": 0, "t": 0, ".": 0}
        self.low = self.high = None
        self.n_turns = self.illegal = 0
        self.initial: str | None = None
        self.hash, self.any = hashlib.sha256(), False

    def add(self, r: dict) -> None:
        if not self.audit:
            self.cost = r["cost"]
        self.audit.append(r["audit"])
        for f in r["faults"]:
            self.faults[f] += 1
        if r["first_turn"] is not None:
            self.n_turns += r["n_turns"] - (self.high == r["first_turn"])
            self.low = r["first_turn"] if self.low is None else self.low
            self.high = r["last_turn"]
        for role in r["roles"]:
            now = role[:1]
            self.illegal += self.initial is not None and self.initial + now not in LEGAL
            self.initial = now
        for _, role, text in replay(r["entry"], r["audit"], r["roles"], r["texts"]):
            self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        return self.conv, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def repair_conversations(turns: DataFrame, copies: str | None = None, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``gaps`` (missing turn numbers), counts of ``blank``, ``duplicate`` and
    ``truncated`` turns and of ``illegal`` neighbours, the repair's ``cost`` and ``audit``, and ``repaired_sha256``."""
    short, long = solve_chunks(stage(cut_chunks(turns, copies, chunk_rows, chunk_chars), "turns"))
    schema = StructType([turns.select("conv_id").schema.fields[0], *StructType.fromDDL(SUMMARY).fields])
    used = ["conv_id", "entry", "cost", "audit", "faults", "roles", "texts", "first_turn", "last_turn", "n_turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur: _Sum | None = None
        kind = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kind] + [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            rows = []
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    if cur is None or cur.conv != r["conv_id"]:
                        if cur is not None:
                            rows.append(cur.row())
                        cur = _Sum(r["conv_id"])
                    cur.add(r)
            if rows:
                yield out(rows)
        if cur is not None:
            yield out([cur.row()])

    # the chunks of a long conversation pass one by one, in order
    ordered = long.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return short.select(*used).mapInArrow(run, schema).unionByName(ordered.select(*used).mapInArrow(run, schema))


def repaired_turns(turns: DataFrame, copies: str | None = None, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The turns after the repair: ``conv_id``, ``chunk`` and ``place`` (their order), ``edit`` (K, R or I), ``role`` and ``text``."""
    short, long = solve_chunks(stage(cut_chunks(turns, copies, chunk_rows, chunk_chars), "turns"))
    schema = StructType([turns.select("conv_id").schema.fields[0], *StructType.fromDDL("chunk bigint, place int, edit string, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [(r["conv_id"], r["chunk"], k, *t) for r in part.to_pylist() for k, t in enumerate(replay(r["entry"], r["audit"], r["roles"], r["texts"]))]
                if rows:
                    kinds = [part.schema.field(0).type, pa.int64(), pa.int32()] + [pa.string()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

    return short.unionByName(long).select("conv_id", "chunk", "entry", "audit", "roles", "texts").mapInArrow(run, schema)

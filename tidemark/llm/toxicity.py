"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as two vectors: one for the word itself, one for its characters (the
sum over its hashed character trigrams, edges marked, and its first 4 to 8 bytes).  A GRU reads a window of words
forwards, another backwards; attention pools their states; a logistic unit gives the
window's score.  A document's score is the highest of its overlapping windows, and
the windows cover the whole text.

Training runs in numpy on the driver, on a bounded sample of labelled rows: at most
``per_class`` documents a class, of at most ``max_chars`` characters (both are
parameters).  Rows with crc32(id) mod 5 = 0 are never learned from.  A label marks a
document, not a window, so a step learns the highest window of toxic documents (at
first the one with the highest log odds of its words), and of the others the highest
windows and random ones.  The highest windows are found anew four times.

Scoring runs inside the tasks that read the texts, without a shuffle.  The parts of
the gates that depend on a word alone are computed once for each word of a task and
looked up, so a step costs one lookup and one small matrix product.

Defined results: a null or empty text is one empty window; a null id counts as held
out; labels that are null are ignored; without both classes in the sample every
score is the share of toxic rows in it (0 without rows).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts

LENGTH = 48  # words in a window
STRIDE = 24
HIDDEN = 8  # units in each direction
BUCKETS = 1 << 14
DIMS = 8  # of the word vector and of the character vector
PER_CLASS = 1500
MAX_CHARS = 20_000
STEPS = 480
BATCH = 256  # windows in a step, half of them of toxic documents
RATE = 0.01  # at the first step, falling to zero
HEADS = range(4, 9)  # lengths of word beginnings
CACHE = 150_000  # words a task keeps
_EDGE = re.compile(rb"^[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+|[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+$")

_HASH = np.array([pow(0x9E3779B1, 3, 1 << 32), 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, buckets of all their trigrams, where each word's trigrams begin, and
    buckets of its beginnings of 4 to 8 bytes (the edge mark is one; 0 where the word is shorter)."""
    bare = [b"^" + _EDGE.sub(b"", w) + b"$ " for w in words]
    raw = np.frombuffer(b"".join(bare) + b"  ", np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in bare])
    first = np.cumsum(sizes) - sizes
    grams = (raw[:-2] * _HASH[0] + raw[1:-1] * _HASH[1] + raw[2:] * _HASH[2]) & np.uint64(0xFFFFFFFF)
    grams = ((grams ^ (grams >> np.uint64(15))) * np.uint64(0x2C1B3C6D) >> np.uint64(7)) % np.uint64(BUCKETS)
    # a word "^abc$ " has the trigrams that begin before its "$"
    keep = np.ones(int(sizes.sum()), bool)
    keep[first + sizes - 1] = False
    keep[first + sizes - 2] = False
    starts = np.cumsum(sizes - 2) - (sizes - 2)
    place = np.arange(len(keep)) - np.repeat(first, sizes)
    mixed = (raw[: len(keep)] + np.uint64(1)) * (np.uint64(0x9E3779B97F4A7C15) ** (place % 61 + 1).astype(np.uint64))
    whole = np.add.reduceat(mixed, first)
    whole = ((whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)) % np.uint64(BUCKETS)
    heads = np.zeros((len(words), len(HEADS)), np.int64)
    code = np.zeros(len(words), np.uint64)
    for k in range(HEADS[-1]):
        code = (code ^ raw[np.minimum(first + k, len(raw) - 1)]) * np.uint64(0x100000001B3)
        if k + 1 in HEADS:
            at = ((code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(13)) % np.uint64(2 * BUCKETS - 1) + np.uint64(1)
            heads[:, k + 1 - HEADS[0]] = np.where(sizes - 2 >= k + 1, at, 0)
    return whole.astype(np.int64), grams[: len(keep)][keep].astype(np.int64), starts, heads


def window_starts(n: int) -> range | list[int]:
    """Starts of the windows over n words; the last window ends with the text."""
    if n <= LENGTH:
        return [0]
    out = list(range(0, n - LENGTH, STRIDE))
    return out + [n - LENGTH]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def initial(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d, h = 2 * DIMS, HIDDEN
    f = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    return {
        "word": f(BUCKETS, DIMS, scale=0.1), "char": f(BUCKETS, DIMS, scale=0.1), "head": np.zeros((2 * BUCKETS, DIMS), np.float32),
        "wx": f(2, d, 3 * h, scale=d**-0.5), "bx": np.zeros((2, 3 * h), np.float32), "u": f(2, h, 3 * h, scale=h**-0.5),
        "att": f(2 * h, scale=0.3), "out": f(2 * h, scale=0.3), "bias": np.zeros(1, np.float32),
    }


def embed(p: dict, words: list[bytes]) -> tuple[np.ndarray, tuple]:
    if not words:
        return np.zeros((0, 2 * DIMS), np.float32), ()
    features = whole, grams, starts, heads = word_features(words)
    chars = np.add.reduceat(p["char"][grams], starts, axis=0) + p["head"][heads].sum(axis=1)
    return np.concatenate((p["word"][whole], chars), axis=1), features


def gates(p: dict, x: np.ndarray) -> np.ndarray:
    """Input side of the gates of both directions; row 0 is the empty place after a short text."""
    g = np.einsum("nd,kdg->nkg", x, p["wx"]).astype(np.float32) + p["bx"]
    return np.concatenate((np.zeros((1, 2, 3 * HIDDEN), np.float32), g))


def forward(p: dict, g: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logits of windows ``ids`` (window, place) into rows of ``g``; with ``keep`` also what the way back needs."""
    n, length = ids.shape
    h = HIDDEN
    state = np.zeros((2, n, h), np.float32)
    states = np.empty((2, length, n, h), np.float32)
    saved = []
    flat = g.reshape(len(g), -1)
    across = np.ascontiguousarray(ids.T)
    for t in range(length):
        x = np.stack((flat[across[t], : 3 * h], flat[across[length - 1 - t], 3 * h :]))
        hu = state @ p["u"]
        zr = sigmoid(x[..., : 2 * h] + hu[..., : 2 * h])
        z, r = zr[..., :h], zr[..., h:]
        c = np.tanh(x[..., 2 * h :] + r * hu[..., 2 * h :])
        if keep:
            saved.append((state, z, r, c, hu[..., 2 * h :]))
        state = c + z * (state - c)
        states[0, t], states[1, length - 1 - t] = state[0], state[1]
    e = states[0] @ p["att"][:h] + states[1] @ p["att"][h:]
    there = across > 0
    e = np.where(there, e, -1e9)
    a = np.exp(e - e.max(axis=0)) * there
    a /= np.maximum(a.sum(axis=0), 1e-9)
    pooled = np.concatenate(((a[..., None] * states[0]).sum(axis=0), (a[..., None] * states[1]).sum(axis=0)), axis=1)
    logit = pooled @ p["out"] + p["bias"][0]
    return (logit, (states, saved, a, pooled)) if keep else logit


def backward(p: dict, g: np.ndarray, ids: np.ndarray, kept: tuple, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters above the gates' inputs, and of ``g``."""
    states, saved, a, pooled = kept
    n, length = ids.shape
    h = HIDDEN
    grad = {"out": pooled.T @ dlogit, "bias": np.array([dlogit.sum()], np.float32), "u": np.zeros_like(p["u"])}
    dpool = dlogit[:, None] * p["out"]
    both = np.concatenate((states[0], states[1]), axis=2)
    da = (both * dpool).sum(axis=2)
    de = a * (da - (a * da).sum(axis=0))
    grad["att"] = np.einsum("lnk,ln->k", both, de)
    dboth = a[..., None] * dpool + de[..., None] * p["att"]
    dg = np.zeros((len(g), 2 * 3 * h), np.float32)
    dstate = np.zeros((2, n, h), np.float32)
    for t in range(length - 1, -1, -1):
        before, z, r, c, hc = saved[t]
        dstate = dstate + np.stack((dboth[t, :, :h], dboth[length - 1 - t, :, h:]))
        dz = dstate * (before - c) * z * (1 - z)
        dc = dstate * (1 - z) * (1 - c * c)
        dr = dc * hc * r * (1 - r)
        dhu = np.concatenate((dz, dr, dc * r), axis=2)
        dx = np.concatenate((dz, dr, dc), axis=2)
        grad["u"] += np.swapaxes(before, 1, 2) @ dhu
        dstate = dstate * z + dhu @ np.swapaxes(p["u"], 1, 2)
        np.add.at(dg, (ids[:, t], slice(0, 3 * h)), dx[0])
        np.add.at(dg, (ids[:, length - 1 - t], slice(3 * h, None)), dx[1])
    dg[0] = 0
    return grad, dg.reshape(len(g), 2, 3 * h)


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.m, self.v, self.t = rate, {}, {}, 0

    def step(self, p: dict, grad: dict) -> None:
        self.t += 1
        scale = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        for k, d in grad.items():
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * d
            v = self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * d * d
            p[k] = (p[k] - scale * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def _windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of word numbers (from 1, 0 where there is none), and the document of each."""
    rows, owner = [], []
    for d, ids in enumerate(docs):
        for s in window_starts(len(ids)):
            row = np.zeros(LENGTH, np.int64)
            part = ids[s : s + LENGTH]
            row[: len(part)] = part
            rows.append(row)
            owner.append(d)
    return np.array(rows, np.int64).reshape(-1, LENGTH), np.array(owner, np.int64)


def score_windows(p: dict, g: np.ndarray, windows: np.ndarray, block: int = 4096) -> np.ndarray:
    return np.concatenate([forward(p, g, windows[k : k + block]) for k in range(0, len(windows), block)]) if len(windows) else np.zeros(0, np.float32)


def train(texts: list[str], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network on labelled texts (both classes needed)."""
    rng = np.random.default_rng(seed)
    p = initial(rng)
    number: dict[bytes, int] = {}
    docs = [np.array([number.setdefault(w, len(number) + 1) for w in tokens(t)], np.int64) for t in texts]
    vocabulary = list(number)
    if not vocabulary:
        p["bias"][0] = np.log((labels.sum() + 0.5) / ((1 - labels).sum() + 0.5))
        return p
    windows, owner = _windows(docs)
    # documents with a word, by class, give its log odds: the first choice of windows
    seen = np.zeros((2, len(vocabulary) + 1))
    for d, ids in enumerate(docs):
        seen[int(labels[d]), np.unique(ids)] += 1
    total = np.array([max(1, (labels == 0).sum()), max(1, (labels == 1).sum())])
    bucket, _, _, heads = word_features(vocabulary)
    seen_heads = np.zeros((2, 2 * BUCKETS))
    for d, ids in enumerate(docs):
        if len(ids):
            seen_heads[int(labels[d]), np.unique(heads[ids - 1])] += 1

    def log_odds(count: np.ndarray, least: int) -> np.ndarray:
        out = np.log((count[1] + 0.1) / total[1]) - np.log((count[0] + 0.1) / total[0])
        out[count.sum(axis=0) < least] = 0
        out[0] = 0
        return out

    odds, head_odds = log_odds(seen, 3), log_odds(seen_heads, 5)
    best = odds.copy()
    best[1:] = np.maximum(odds[1:], head_odds[heads].max(axis=1))
    value = np.maximum(best, 0)[windows].max(axis=1) + 1e-3 * rng.random(len(windows))
    # vectors start with the log odds; a word of fewer than three documents has no vector, so its
    # characters must do
    common = seen.sum(axis=0)[1:] >= 3
    p["word"][:] = 0
    p["word"][bucket[common]] = rng.standard_normal((int(common.sum()), DIMS)) * 0.1
    p["word"][bucket[common], 0] = np.clip(odds[1:][common], -4, 4) / 2
    p["head"][:, 0] = np.clip(head_odds, -4, 4) / 4
    learn = np.zeros((BUCKETS, 1), np.float32)
    learn[bucket[common]] = 1
    learn_heads = (seen_heads.sum(axis=0) >= 5)[:, None].astype(np.float32)
    learn_heads[0] = 0
    adam = _Adam(RATE)
    by_doc = np.argsort(owner, kind="stable")
    toxic_docs, clean = np.flatnonzero(labels == 1), np.flatnonzero(labels[owner] == 0)
    for step in range(steps):
        if step % (steps // 4) == 0:
            if step:
                value = score_windows(p, gates(p, embed(p, vocabulary)[0]), windows)
            order = by_doc[np.lexsort((-value[by_doc], owner[by_doc]))]
            head = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]  # by document
            clean_head = head[labels == 0]
        use = np.concatenate((head[rng.choice(toxic_docs, BATCH // 2)], rng.choice(clean_head, BATCH // 4), rng.choice(clean, BATCH // 4)))
        local, ids = np.unique(windows[use], return_inverse=True)
        shift = 0 if local[0] == 0 else 1
        words = [vocabulary[i - 1] for i in local[1 - shift :]]
        if not words:
            continue
        x, (whole, grams, starts, heads) = embed(p, words)
        g = gates(p, x)
        ids = ids.reshape(len(use), LENGTH) + shift
        logit, kept = forward(p, g, ids, keep=True)
        grad, dg = backward(p, g, ids, kept, (sigmoid(logit) - labels[owner[use]].astype(np.float32)) / len(use))
        dg = dg[1:]
        grad["wx"] = np.einsum("nd,nkg->kdg", x, dg)
        grad["bx"] = dg.sum(axis=0)
        dx = np.einsum("nkg,kdg->nd", dg, p["wx"])
        grad["word"] = np.zeros_like(p["word"])
        np.add.at(grad["word"], whole, dx[:, :DIMS])
        grad["char"] = np.zeros_like(p["char"])
        np.add.at(grad["char"], grams, np.repeat(dx[:, DIMS:], np.diff(np.append(starts, len(grams))), axis=0))
        grad["word"] *= learn
        grad["head"] = np.zeros_like(p["head"])
        np.add.at(grad["head"], heads, dx[:, None, DIMS:])
        grad["head"] *= learn_heads
        adam.rate = RATE * (1 - step / steps)
        adam.step(p, grad)
    # the cut between the classes' document scores is moved to 0.5
    x, _ = embed(p, vocabulary)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, owner, score_windows(p, gates(p, x), windows))
    p["bias"][0] -= best_cut(top, labels)
    return p


def best_cut(score: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest errors, a clean document counted five times; in the middle of the widest such gap."""
    order = np.argsort(score)
    s, y = score[order], labels[order]
    missed = np.concatenate(([0], np.cumsum(y == 1)))  # toxic below the cut
    wrong = np.concatenate(([0], np.cumsum(y == 0)))
    errors = missed + 5 * (wrong[-1] - wrong)
    edges = np.concatenate(([s[0] - 2], s, [s[-1] + 2]))
    gaps = edges[1:] - edges[:-1]
    k = max(np.flatnonzero(errors == errors.min()), key=lambda i: gaps[i])
    return float((edges[k] + edges[k + 1]) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int) -> tuple[list[str], np.ndarray]:
    """At most ``per_class`` labelled texts of each class, chosen by a hash of their id; of rows with one id the least text."""
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picks = None
    for y in (0, 1):
        some = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picks = some if picks is None else picks.unionByName(some)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the picks are at most 2 * per_class rows, so they can be broadcast
    rows = docs.select("doc_id", text.alias("text")).where(F.length("text") <= max_chars).join(F.broadcast(picks), "doc_id")
    # bounded: one row for each pick
    got = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy("doc_id").collect()
    return [r.text for r in got], np.array([r.toxic for r in got], np.int64)


def score_documents(docs: DataFrame, model: dict | float, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``score`` and ``n_windows`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        p = shared.value
        if isinstance(p, float):
            return lambda texts: {"score": [p] * len(texts), "n_windows": [len(window_starts(len(tokens(t)))) for t in texts]}
        number: dict[bytes, int] = {}
        table = gates(p, np.zeros((0, 2 * DIMS), np.float32))

        def add(new: list[bytes]) -> None:
            nonlocal table
            table = np.concatenate((table, gates(p, embed(p, new)[0])[1:]))

        def pieces(texts: list[str]) -> Iterator[list[str]]:
            part, size = [], 0
            for t in texts:
                part.append(t)
                size += len(t)
                if size > 600_000:
                    yield part
                    part, size = [], 0
            yield part

        def go(texts: list[str]) -> dict[str, list]:
            nonlocal table
            score, count = [], []
            for part in pieces(texts):
                if not part:
                    continue
                if len(number) > CACHE:
                    number.clear()
                    table = table[:1]
                lists = [tokens(t) for t in part]
                new = list(dict.fromkeys(w for ws in lists for w in ws if w not in number))
                if new:
                    number.update(zip(new, range(len(number) + 1, len(number) + len(new) + 1)))
                    add(new)
                windows, owner = _windows([np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)) for ws in lists])
                top = np.full(len(part), -np.inf)
                np.maximum.at(top, owner, score_windows(p, table, windows, 1024))
                score += sigmoid(top).astype(np.float64).tolist()
                count += np.bincount(owner, minlength=len(part)).tolist()
            return {"score": score, "n_windows": count}

        return go

    rows = docs.select(*carry, F.col("text").cast("string").alias("scored_text"))
    return map_texts(rows, make, [("score", pa.float64()), ("n_windows", pa.int64())], "scored_text")


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS, steps: int = STEPS, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Train on the bounded sample, then score every window of every document."""
    texts, y = labelled_sample(docs, labels, per_class, max_chars)
    model: dict | float = float(y.mean()) if len(y) else 0.0
    if 0 < y.sum() < len(y):
        model = train(texts, y, steps)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))
    scored = score_documents(docs, model, carry)
    return scored.withColumn("held_out", held_out).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "held_out", "score", "predicted", "n_windows")

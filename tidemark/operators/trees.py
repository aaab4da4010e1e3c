"""Trees of a random forest over binned numbers, in numpy (M6).

A tree is a function of the rows' order, the seed and its own number: its bootstrap counts
come from (seed, tree), the features a node looks at from (seed, tree, the path to it).  So a
forest can be grown in any parts, on any number of machines, and trees that differ in the
least leaf size only are grown together: they share every node down to the first split that
one size forbids.  The rules are those of Spark ML: 32 bins, Gini, counts of drawn rows,
and sibling leaves of one prediction are joined at the end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Bins of a feature; a row's bin and its label share a byte.
BINS = 32
#: Points a part's summary of one feature keeps.
POINTS = 512
#: Nodes whose histograms are held at once, and rows counted or walked at once (few enough for a processor's cache).
NODES, ROWS = 4096, 1 << 15
#: Shares are multiples of this, so that their sums are exact in any order.
SHARE_UNIT = 2.0**-40


def summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in order and how many rows each stands for: all distinct ones, or ``POINTS`` at even ranks."""
    v, n = np.unique(values, return_counts=True)
    if len(v) <= POINTS:
        return v, n.astype(float)
    ends = np.cumsum(n)
    at = np.unique(np.searchsorted(ends, np.arange(1, POINTS + 1) * (ends[-1] / POINTS) - 0.5))
    return v[at], np.diff(np.r_[0, ends[at]]).astype(float)


def thresholds(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """At most ``BINS - 1`` split points of one feature: midpoints between neighbours, all of them or at even counts."""
    v, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.bincount(at, np.concatenate([p[1] for p in parts]))
    mid = v[:-1] + (v[1:] - v[:-1]) / 2
    if len(mid) < BINS:
        return mid
    return mid[np.unique(np.searchsorted(np.cumsum(n)[:-1], np.arange(1, BINS) * (n.sum() / BINS)).clip(max=len(mid) - 1))]


def binned(x: np.ndarray, splits: Sequence[np.ndarray]) -> np.ndarray:
    """Each value's bin, one byte; a value at a split point is left of it."""
    return np.column_stack([np.searchsorted(s, x[:, i], "left") for i, s in enumerate(splits)]).astype(np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(key: np.ndarray, features: int, take: int) -> np.ndarray:
    """``take`` of the features for each node, in order."""
    if take >= features:
        return np.tile(np.arange(features), (len(key), 1))
    lot = _mix(key[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(lot, take - 1, axis=1)[:, :take], axis=1)


@dataclass
class Tree:
    """Nodes level by level, the root first; a leaf has no ``left`` (-1), else its children are ``left`` and ``left + 1``."""

    levels: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    counts: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return self.counts.sum(1)

    @property
    def share(self) -> np.ndarray:
        # a bootstrap of a few rows may hold none, and then says nothing
        return np.round(self.counts[:, 1] / np.maximum(self.rows, 1) / SHARE_UNIT) * SHARE_UNIT

    def of_level(self, i: int) -> slice:
        return slice(self.levels[i], self.levels[i + 1])


def _best(drawn: np.ndarray, counts: np.ndarray, may: np.ndarray, leaves: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """The best split of each node for each leaf size as (feature slot, bin) in one number, -1 for none, and what goes left."""
    k, m = drawn.shape[:2]
    below = drawn.cumsum(2)[:, :, :-1].reshape(k, m * (BINS - 1), 2)
    l0, l1 = np.ascontiguousarray(below[..., 0]), np.ascontiguousarray(below[..., 1])
    r0, r1 = counts[:, :1] - l0, counts[:, 1:] - l1
    nl, nr = l0 + l1, r0 + r1
    # the purer the children, the larger: the node's own value is the least there is
    value = (l0 * l0 + l1 * l1) / np.maximum(nl, 1) + (r0 * r0 + r1 * r1) / np.maximum(nr, 1)
    own = (counts**2).sum(1) / counts.sum(1) * (1 + 1e-12)
    least, every = np.minimum(nl, nr), np.arange(k)
    choice, left = np.full((k, len(leaves)), -1), np.zeros((k, len(leaves), 2))
    for i, leaf in enumerate(leaves):
        allowed = np.where(least >= leaf, value, -1.0)
        at = allowed.argmax(1)
        choice[:, i] = np.where(may[:, i] & (allowed[every, at] > own), at, -1)
        left[:, i] = below[every, at]
    return choice, left


def grow(z: np.ndarray, features: int, tree: int, leaves: Sequence[int], seed: int, take: int, max_depth: int) -> list[Tree]:
    """Tree number ``tree`` for each least leaf size; ``z`` has a row's bins doubled, plus its label."""
    flat, width = z.reshape(-1), z.shape[1]
    drawn = np.random.default_rng([seed & 0xFFFFFFFF, tree]).poisson(1.0, len(z)).astype(np.uint8)
    rows = np.flatnonzero(drawn).astype(np.int32)
    weight, node = drawn[rows], np.zeros(len(rows), np.int32)
    counts = np.bincount(z[rows, 0] & 1, weight, minlength=2)[None]
    mask = np.ones((1, len(leaves)), bool)
    with np.errstate(over="ignore"):
        key = _mix(np.array([seed & 0xFFFFFFFF], np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(tree + 1))
    starts, found = [0], []
    for depth in range(max_depth + 1):
        k = len(counts)
        may = mask & (counts.min(1) > 0)[:, None] & (counts.sum(1)[:, None] >= 2 * np.array(leaves)) & (depth < max_depth)
        feature, split, left = np.zeros((len(leaves), k), np.int8), np.zeros((len(leaves), k), np.uint8), np.full((len(leaves), k), -1, np.int32)
        found.append((counts, feature, split, left))
        starts.append(starts[-1] + k)
        inner = np.flatnonzero(may.any(1))
        if not len(inner):
            break
        index = np.full(k, -1, np.int32)
        index[inner] = np.arange(len(inner))
        node = index[node]
        on = node >= 0
        rows, weight, node = rows[on], weight[on], node[on]
        looked = _drawn(key[inner], features, take)
        choice, below = [], []
        for lo in range(0, len(inner), NODES):
            hi = min(lo + NODES, len(inner))
            part = slice(None) if hi - lo == len(inner) else np.flatnonzero((node >= lo) & (node < hi))
            r, n, w = rows[part], node[part] - lo, weight[part]
            total = np.zeros((hi - lo, take, BINS, 2))
            step = max(ROWS, 2 * BINS * (hi - lo))
            for a in range(0, len(r), step):
                own, by = n[a : a + step], w[a : a + step].astype(float)
                at, cell = r[a : a + step].astype(np.int64) * width, own.astype(np.int64) * (2 * BINS)
                for j in range(take):
                    value = flat.take(at + looked[lo:hi, j].take(own))
                    total[:, j] += np.bincount(cell + value, by, minlength=(hi - lo) * 2 * BINS).reshape(-1, BINS, 2)
            c, b = _best(total, counts[inner[lo:hi]], may[inner[lo:hi]], leaves)
            choice.append(c)
            below.append(b)
        choice, below = np.concatenate(choice), np.concatenate(below)
        # a node whose leaf sizes want different splits goes on as several
        of, size = np.nonzero(choice >= 0)
        if not len(of):
            break
        wide = take * (BINS - 1)
        forks, first, at = np.unique(of * wide + choice[of, size], return_index=True, return_inverse=True)
        parent, cut = forks // wide, forks % wide
        by, bins = looked[parent, cut // (BINS - 1)], (cut % (BINS - 1)).astype(np.uint8)
        feature[size, inner[of]], split[size, inner[of]], left[size, inner[of]] = by[at], bins[at], starts[-1] + 2 * at
        goes = below[of[first], size[first]]
        own = counts[inner[parent]]
        counts = np.stack((goes, own - goes), 1).reshape(-1, 2)
        mask = np.zeros((len(forks), len(leaves)), bool)
        mask[at, size] = True
        mask = np.repeat(mask, 2, axis=0)
        key = _mix(key[inner[parent]][:, None] + np.array([0x9E3779B97F4A7C15, 0x3C6EF372FE94F82B], np.uint64)).reshape(-1)
        each = np.bincount(parent, minlength=len(inner))
        begin = (np.cumsum(each) - each).astype(np.int32)
        if each.max() > 1:
            times = each[node]
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows, weight, node = np.repeat(rows, times), np.repeat(weight, times), (begin[np.repeat(node, times)] + nth).astype(np.int32)
        else:
            on = each[node] > 0
            rows, weight, node = rows[on], weight[on], begin[node[on]]
        node = 2 * node + ((flat[rows.astype(np.int64) * width + by[node]] >> 1) > bins[node])
    levels = np.array(starts)
    joined = [np.concatenate([f[0] for f in found]), *(np.concatenate([f[i] for f in found], axis=1) for i in (1, 2, 3))]
    return [_one(levels, joined[0], joined[1][i], joined[2][i], joined[3][i]) for i in range(len(leaves))]


def _one(levels: np.ndarray, counts: np.ndarray, feature: np.ndarray, split: np.ndarray, left: np.ndarray) -> Tree:
    """One leaf size's own nodes, sibling leaves of one prediction joined."""
    left, deep = left.copy(), len(levels) - 1
    says = counts[:, 1] > counts[:, 0]
    for i in reversed(range(deep)):
        at = levels[i] + np.flatnonzero(left[levels[i] : levels[i + 1]] >= 0)
        a, b = left[at], left[at] + 1
        left[at[(left[a] < 0) & (left[b] < 0) & (says[a] == says[b])]] = -1
    own = np.zeros(len(left), bool)
    own[0] = True
    for i in range(deep):
        at = levels[i] + np.flatnonzero(own[levels[i] : levels[i + 1]])
        at = left[at[left[at] >= 0]]
        own[at] = own[at + 1] = True
    return _kept(Tree(levels, feature, split, left, counts), own)


def _kept(tree: Tree, own: np.ndarray) -> Tree:
    """The nodes ``own`` of a tree, numbered anew; they hold the children of every inner one among them."""
    new = np.cumsum(own) - 1
    left = tree.left[own]
    levels = np.unique(np.r_[0, new[tree.levels[1:] - 1] + 1])
    return Tree(levels, tree.feature[own], tree.bin[own], np.where(left >= 0, new[left], -1), tree.counts[own])


def cut(tree: Tree, depth: int, least: int) -> Tree:
    """The tree stopped at a depth and at nodes of fewer than ``least`` rows."""
    left, own = np.where(tree.rows < least, -1, tree.left), np.zeros(len(tree.left), bool)
    own[0] = True
    for i in range(len(tree.levels) - 1):
        at = tree.levels[i] + np.flatnonzero(own[tree.of_level(i)])
        if i >= depth:
            left[at] = -1
        at = left[at[left[at] >= 0]]
        own[at] = own[at + 1] = True
    return _kept(Tree(tree.levels, tree.feature, tree.bin, left, tree.counts), own)


def add_shares(tree: Tree, bins: np.ndarray, depths: Sequence[int], splits: Sequence[int], total: np.ndarray) -> None:
    """Add to ``total`` (depth, row, split size) the share of class 1 that the tree, stopped there, has for each row."""
    # what a walk that ends at a node answers: the first node on the way with too few rows, or this one
    few = tree.rows[:, None] < np.array(splits)
    answer = np.repeat(tree.share[:, None], len(splits), axis=1)
    for i in range(len(tree.levels) - 2):
        at = tree.levels[i] + np.flatnonzero(tree.left[tree.of_level(i)] >= 0)
        for child in (tree.left[at], tree.left[at] + 1):
            answer[child] = np.where(few[at], answer[at], answer[child])
            few[child] |= few[at]
    order, width = np.argsort(depths, kind="stable"), bins.shape[1]
    left, feature, split = tree.left, tree.feature.astype(np.int32), tree.bin
    for lo in range(0, len(bins), ROWS):
        flat, rows = bins[lo : lo + ROWS].reshape(-1), min(ROWS, len(bins) - lo)
        at, on = np.zeros(rows, np.int32), np.arange(rows if left[0] >= 0 else 0, dtype=np.int32)
        level, said = 0, None
        for i in order:
            while level < depths[i] and len(on):
                here = at.take(on)
                down = left.take(here) + (flat.take(on * width + feature.take(here)) > split.take(here))
                at[on], said = down, None
                on = on[left.take(down) >= 0]
                level += 1
            if said is None:
                said = answer.take(at, axis=0)
            total[i, lo : lo + ROWS] += said


def table_of(held: dict[tuple[int, int, int], bytes], width: int) -> tuple[np.ndarray, int]:
    """The rows of all pieces in the order of their names, and how many of them have names from 0; takes the pieces out."""
    out = np.empty((sum(map(len, held.values())) // width, width), np.uint8)
    at = first = 0
    for name in sorted(held):
        piece = np.frombuffer(held.pop(name), np.uint8).reshape(-1, width)
        out[at : at + len(piece)] = piece
        at += len(piece)
        first += len(piece) * (name[0] == 0)
    return out, first


def auc(score: np.ndarray, label: np.ndarray) -> float | None:
    """ROC AUC, ties at their mean rank; none for rows of one class."""
    p = int(label.sum())
    n = len(label) - p
    if not p or not n:
        return None
    _, at, size = np.unique(score, return_inverse=True, return_counts=True)
    rank = np.cumsum(size) - (size - 1) / 2
    return (math.fsum(np.bincount(at, label, minlength=len(size)) * rank) - p * (p + 1) / 2) / (p * n)

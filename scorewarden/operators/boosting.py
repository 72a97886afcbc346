"""Boosted trees and forests over binned features: many fits in one pass, and what each feature adds to a score.

A fit belongs to a set of rows (a window, a fold) and a candidate. All fits grow level by level from histograms of first and
second derivatives per (set, candidate, tree, node, feature, bin). Rows of a set with equal bins, label and weight are one cell, which
Spark counts before a fit: they are always in the same node and have the same derivatives, so that a tree only needs how many of them it
draws. That number is drawn at once, by the law that it has if each row is drawn alone, so that a tree costs what its cells cost. Cells
are kept in blocks, of a column per feature each. Where the cells of the largest set fit one task, each
fit grows in a task of its own; beyond that one job per level adds up the histograms of all fits over all tasks. Both ways call
the same functions on the same sums. The sums of leaves at the full depth follow from the last split. Models are rows of a table; their size follows from the parameters alone.

Splits follow second-order boosting: with G and H the sums of both derivatives, a leaf has the weight -soft(G, l1) / (H + l2), held
within ``max_step`` if that is above 0, and a split the gain of its leaves over their parent. After a tree has grown to its
depth, splits above leaves whose gain is below ``gamma`` are taken back from the bottom up. A forest is the same with squared loss, no
penalties, counts drawn per tree and its own choice of features per node.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, fields
from functools import lru_cache
from math import ceil, factorial, floor, inf, prod, sqrt

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden.storage import settled

#: Bytes of binned rows that one task may fit alone.
TASK_BYTES = 192 << 20
#: Bytes of partial sums of one level that the driver adds up itself; more are added up by tasks.
SUMS_BYTES = 8 << 20
#: Rows of a block, few enough for what is computed of them to stay in a processor's cache, and of a task's share of all blocks.
BLOCK_ROWS, SHARE_ROWS = 1 << 15, 1 << 21
#: Bytes of models that go to the executors at once.
MODEL_BYTES = 16 << 20
#: Bytes of a node that scores need: feature, place of the cut, value.
SLIM_BYTES = 12
#: Cells between the cuts of a model whose scores a task may hold.
SCORE_CELLS = 1 << 20
#: Trees of a forest that grow in one pass, and rounds between two stored states.
TREES_AT_ONCE, ROUNDS_STORED = 16, 8
#: Bits of a cell's number of rows that are drawn from one table, and of a share by which most draws are looked up.
DIGIT, GUIDE = 6, 10
_LEAF, _NONE = -1, -2
_STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Spec:
    """Parameters of a fit; ``min_leaf`` bounds the second derivatives of a leaf, in a forest its rows."""

    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    min_leaf: float = 1.0
    min_split: float = 0.0
    subsample: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    gamma: float = 0.0
    max_step: float = 0.0
    patience: int = 30
    forest: bool = False

    @staticmethod
    def of(kind: str, params: Mapping[str, float]) -> Spec:
        known = {f.name: params[f.name] for f in fields(Spec) if f.name in params}
        whole = {k: int(known[k]) for k in ("trees", "depth", "patience") if k in known}
        return Spec(**{**known, **whole}, forest=kind == "random_forest")

    @property
    def size(self) -> int:
        """Places of a complete tree."""
        return (2 << self.depth) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shares(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on a row's hash and a salt alone."""
    return (mixed(h + _salt(salt)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def _salt(number: int) -> np.uint64:
    return np.uint64((number + 1) * _STEP % (1 << 64))


def drawn_weights(h: np.ndarray, tree: int, s: Spec) -> np.ndarray:
    """How often each row counts in a tree: a draw with replacement for forests, a subsample for boosting."""
    if not s.forest and s.subsample >= 1:
        return np.ones(len(h), np.uint8)
    # a share reaches a limit if the whole hash reaches it as a number of 53 bits, moved up
    limits = np.cumsum([np.exp(-1.0) / factorial(i) for i in range(12)]) if s.forest else [s.subsample]
    limits = [np.uint64(ceil(x * 2.0 ** 53) << 11) for x in limits]
    out = np.empty(len(h), np.uint8)
    for p in blocks_of(len(h)):
        share, count = mixed(h[p] + _salt(tree)), out[p]
        if not s.forest:
            np.less(share, limits[0], out=count.view(bool))
            continue
        count[:] = 0
        for limit in limits:
            over = share >= limit
            count += over.view(np.uint8)
            if not over.any():
                break
    return out


@lru_cache(maxsize=64)
def _draws(level: int, share: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One after another for d in [0, 2 ** DIGIT): d plus the chances that of d << (DIGIT * level) rows at most so many count (``share``
    None: with replacement) or are left out (a subsample); what to take from a place in there to get that number; and the places
    that all shares with the same first bits have, -1 where they differ."""
    table, first = [], []
    for d in range(1 << DIGIT):
        rows = d << (DIGIT * level)
        mean = rows * (1.0 if share is None else 1 - share)
        far = 12 * sqrt(mean if share is None else mean * share) + 40  # beyond that chances are below what a number can hold
        low, high = max(0, floor(mean - far)), ceil(mean + far) if share is None else min(rows, ceil(mean + far))
        k = np.arange(low, high if rows else low)
        with np.errstate(divide="ignore"):
            steps = np.log(mean / (k + 1)) if share is None else np.log((rows - k) / (k + 1) * ((1 - share) / share))
        chance = np.concatenate([[0.0], np.cumsum(steps)])
        chance = np.exp(chance - chance.max()).cumsum()
        first.append(sum(map(len, table)) - low)
        table.append(d + chance / chance[-1])
    whole = np.concatenate(table)
    ends = np.searchsorted(whole, np.arange((1 << (DIGIT + GUIDE)) + 1) / (1 << GUIDE), "right")
    return whole, np.array(first), np.where(ends[1:] == ends[:-1], ends[:-1], -1)


def drawn_sums(h: np.ndarray, n: np.ndarray, tree: int, s: Spec) -> np.ndarray:
    """How often the ``n`` equal rows of each cell count in a tree, drawn at once: binomial in a subsample, Poisson in a forest.

    A number of rows is drawn digit by digit, each by its own share, as a sum of independent draws has the law of the whole.
    """
    n = n.astype(np.int64)
    if not s.forest and not 0 < s.subsample < 1:
        return n if s.subsample >= 1 else np.zeros_like(n)
    out, share = np.zeros(len(h), np.int64), None if s.forest else s.subsample
    for p in blocks_of(len(h)):
        level, left = 0, n[p]
        while True:
            at = slice(None) if not level else np.flatnonzero(left & ((1 << DIGIT) - 1))
            digit, (table, first, guide) = left[at] & ((1 << DIGIT) - 1), _draws(level, share)
            spot = mixed(h[p][at] + _salt(tree + (level << 32))) >> np.uint64(18)  # no bit is lost beside a digit
            found = guide[(digit << GUIDE) + (spot >> np.uint64(46 - GUIDE)).astype(np.int64)]
            open_ = np.flatnonzero(found < 0)
            found[open_] = np.searchsorted(table, digit[open_] + spot[open_] / 2.0 ** 46, "right")
            found -= first[digit]
            out[p][at] += found if s.forest else (digit << (DIGIT * level)) - found
            left, level = left >> DIGIT, level + 1
            if not left.any():
                break
    return out


def rows_of(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows of each group."""
    return np.diff(np.append(start, len(h))) if h.ndim == 1 else np.add.reduceat(h[:, 1], start).astype(np.int64)


def drawn_counts(h: np.ndarray, start: np.ndarray, tree: int, s: Spec) -> np.ndarray:
    """How often the rows of each group count in a tree; what is known of a group begins at its ``start``: hashes of rows, or hashes of
    cells with their numbers of rows."""
    count = drawn_weights(h, tree, s) if h.ndim == 1 else drawn_sums(h[:, 0], h[:, 1], tree, s)
    return (count if len(start) == len(h) else np.add.reduceat(count, start, dtype=np.int64)).astype(np.float64)


def groups_of(bins: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by the whole numbers in ``more`` and their bins (a row per feature), and where each group of equal rows starts."""
    key, size = np.zeros(bins.shape[1], np.int64), 1
    for v in (*more, *bins):
        n = int(v.max(initial=0)) + 1
        if size * n >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            size = len(found)
        key, size = key * n + v, size * n
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))


def open_features(tree: int, nodes: np.ndarray, n: int, s: Spec) -> np.ndarray:
    """Which features each node may split: a share per tree in boosting, the root of their number per node in forests."""
    keep = max(1, int(sqrt(n))) if s.forest else max(1, ceil(s.columns * n - 1e-9))
    where = nodes if s.forest else np.zeros_like(nodes)
    spots = mixed(_salt(tree) + where[:, None].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.arange(n, dtype=np.uint64))
    return np.argsort(np.argsort(spots, 1), 1) < keep


def leaf_weight(g, h, s: Spec):
    with np.errstate(all="ignore"):
        w = np.where(h + s.l2 > 0, -np.sign(g) * np.maximum(np.abs(g) - s.l1, 0) / (h + s.l2), 0.0)
    return np.clip(w, -s.max_step, s.max_step) if s.max_step > 0 else w


def leaf_gain(g, h, s: Spec):
    """-(2 g w + (h + l2) w w + 2 l1 |w|) at the leaf's weight w, in few steps."""
    t, h = np.abs(g), h + s.l2
    if s.l1:
        t = np.maximum(t - s.l1, 0)
    with np.errstate(all="ignore"):
        step = np.where(h > 0, t / h, 0.0)
    if s.max_step <= 0:
        return t * step
    step = np.minimum(step, s.max_step)
    return step * (2 * t - h * step)


def best_splits(hist: np.ndarray, allowed: np.ndarray, s: Spec):
    """(feature or -1, last bin on the left, gain, sums, sums on the left) per node from sums (node, feature, bin, 3) of derivatives and rows.

    Features that no node may split need no sums.
    """
    # each node may split the same number of features: only those are looked at, in their order
    every, open_ = np.arange(len(hist)), np.argsort(~allowed, 1, kind="stable")[:, : int(allowed[0].sum())]
    hist = np.ascontiguousarray(np.moveaxis(hist[every[:, None], open_], -1, 0))
    left, total = hist.cumsum(3)[..., :-1], hist[:, :, 0].sum(2).T
    right = total.T[:, :, None, None] - left
    at = 2 if s.forest else 1
    fits = (left[at] >= s.min_leaf) & (right[at] >= s.min_leaf) & (left[2] > 0) & (right[2] > 0)
    fits &= (total[:, 2] >= s.min_split)[:, None, None]
    gains = leaf_gain(left[0], left[1], s) + leaf_gain(right[0], right[1], s) - leaf_gain(total[:, 0], total[:, 1], s)[:, None, None]
    flat = np.where(fits, gains, -np.inf).reshape(len(every), -1)
    # sums of the same numbers in another order differ in their last bits; the first of about equal gains wins
    top = flat.max(1, initial=-np.inf)
    best = (flat >= (top - 1e-9 * np.maximum(1, np.abs(top)))[:, None]).argmax(1)
    good = top > 1e-6
    feature, cut = np.divmod(best, left.shape[3])
    return np.where(good, open_[every, feature], _LEAF), np.where(good, cut, 0), np.where(good, top, 0.0), total, left[:, every, feature, cut].T


def reached(feature: np.ndarray, depth: int) -> np.ndarray:
    """The node in heap order that stands for each of the 2 ** depth places of a level: itself, or a leaf further up."""
    nodes = np.zeros(1, np.int64)
    for _ in range(depth):
        split = feature[nodes] >= 0
        nodes = np.stack([np.where(split, 2 * nodes + 1, nodes), np.where(split, 2 * nodes + 2, nodes)], 1).ravel()
    return nodes


def _chosen(b, no, yes):
    """``yes`` where b is 1, else ``no``; None stands for zeros."""
    if b is None or (no is None and yes is None):
        return no
    if no is None:
        return b & yes
    return no & (b ^ 1) if yes is None else no ^ (b & (no ^ yes))


def paths(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Where each row is among the 2 ** depth places of a level; rows in a leaf further up are at its leftmost place.

    ``bins`` has a row per feature. Many rows are compared with one node after another, a byte each; few rows follow their nodes.
    """
    rows = bins.shape[1]
    if depth > 8 or rows < 64 << depth:
        at, every = np.zeros(rows, np.int64), np.arange(rows)
        for level in range(depth):
            node = at + (1 << level) - 1
            f = feature[node]
            at = 2 * at + ((f >= 0) & (bins[np.maximum(f, 0), every] > cut[node]))
        return at
    sides: list = []
    cut = cut.astype(bins.dtype)  # a wider cut would widen every row's bin
    for level in range(depth):
        nodes = range((1 << level) - 1, (2 << level) - 1)
        found = [(bins[feature[i]] > cut[i]).view(np.uint8) if feature[i] >= 0 else None for i in nodes]
        for b in sides:
            half = len(found) // 2
            found = [_chosen(b, found[i], found[i + half]) for i in range(half)]
        sides.append(found[0])
    out = np.zeros(rows, np.uint8)
    for b in sides:
        out <<= 1
        if b is not None:
            out |= b
    return out


class Tree:
    """A tree in heap order: node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, s: Spec):
        self.spec = s
        self.feature, self.cut = np.full(s.size, _NONE, np.int32), np.zeros(s.size, np.int32)
        self.value, self.gain, self.cover, self.rows = (np.zeros(s.size) for _ in range(4))
        self.feature[0] = _LEAF

    def _note(self, nodes: np.ndarray, sums: np.ndarray) -> None:
        self.cover[nodes], self.rows[nodes] = sums[:, 1], sums[:, 2]
        self.value[nodes] = leaf_weight(sums[:, 0], sums[:, 1], self.spec)

    def split(self, nodes: np.ndarray, feature, cut, gain, total, left, last: bool) -> np.ndarray:
        """Note the splits of one level and the sums of both sides; returns the nodes of the next."""
        self._note(nodes, total)
        good = (feature >= 0) & (not last)
        self.feature[nodes] = np.where(good, feature, _LEAF)
        self.cut[nodes], self.gain[nodes] = np.where(good, cut, 0), np.where(good, gain, 0.0)
        self._note(2 * nodes[good] + 1, left[good])
        self._note(2 * nodes[good] + 2, total[good] - left[good])
        children = np.sort(np.concatenate([2 * nodes[good] + 1, 2 * nodes[good] + 2]))
        self.feature[children] = _LEAF
        return children

    def pruned(self) -> Tree:
        for i in range(self.spec.size // 2 - 1, -1, -1):
            if self.feature[i] >= 0 and self.gain[i] < self.spec.gamma and self.feature[2 * i + 1] == self.feature[2 * i + 2] == _LEAF:
                self.feature[i], self.gain[i] = _LEAF, 0.0
                self.feature[[2 * i + 1, 2 * i + 2]] = _NONE
        return self

    def values(self, bins: np.ndarray) -> np.ndarray:
        """The value that each row gets; ``bins`` has a row per feature."""
        return self.value[reached(self.feature, self.spec.depth)][paths(bins, self.feature, self.cut, self.spec.depth)]


def histograms(bins: np.ndarray, place: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, n: np.ndarray | None, width: int, features: np.ndarray) -> np.ndarray:
    """Sums (node, feature, bin, 3) of the rows whose ``place`` is a node, the number of nodes for none; ``n`` is 1 if None."""
    out = np.zeros((nodes, len(bins), width, 3))
    base = place.astype(np.int64) * width
    for f in features:
        key = base + bins[f]
        for i, v in enumerate((g, h, n)):
            out[:, f, :, i] = np.bincount(key, v, minlength=(nodes + 1) * width)[: nodes * width].reshape(nodes, width)
    return out


def derivatives(y, w, margin, count, s: Spec):
    """First and second derivatives of the loss, times how often a row counts."""
    if s.forest:
        return -w * y * count, w * count
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y) * count, w * p * (1 - p) * count


def drawn(bins, y, w, margin, count, s: Spec):
    """Bins (a row per feature), both derivatives and counts of the rows or groups that take part in a tree; no counts if all are 1."""
    if not count.all():
        use = np.flatnonzero(count)
        bins, y, w, margin, count = bins[:, use], y[use], w[use], margin[use], count[use]
    return bins, *derivatives(y, w, margin, count, s), count if count.max(initial=1) > 1 else None


def drawn_parts(bins, y, w, h, start, margin, tree: int, s: Spec) -> list:
    """What takes part in a tree, block by block."""
    count = drawn_counts(h, start, tree, s)
    return [drawn(bins[:, p], y[p], w[p], margin[p], count[p], s) for p in blocks_of(len(y))]


def level_sums(rows, tree: Tree, nodes: np.ndarray, level: int, width: int, open_: np.ndarray) -> np.ndarray:
    """Histograms of the drawn rows in the nodes of a level, for features that any of them may split."""
    bins, *sums = rows
    order = np.full(1 << level, len(nodes), np.int64)
    order[nodes - (1 << level) + 1] = np.arange(len(nodes))
    return histograms(bins, order[paths(bins, tree.feature, tree.cut, level)], len(nodes), *sums, width, np.flatnonzero(open_.any(0)))


def blocks_of(rows: int) -> list[slice]:
    return [slice(a, a + BLOCK_ROWS) for a in range(0, rows, BLOCK_ROWS)]


def grow(bins, y, w, h, margin, tree: int, s: Spec, width: int, start: np.ndarray | None = None) -> Tree:
    """One tree of rows, or of groups whose hashes begin at ``start``."""
    parts = drawn_parts(bins.T, y, w, h, np.arange(len(y)) if start is None else start, margin, tree, s)
    out, nodes = Tree(s), np.zeros(1, np.int64)
    for level in range(max(1, s.depth)):
        open_ = open_features(tree, nodes, bins.shape[1], s)
        hist = sum(level_sums(p, out, nodes, level, width, open_) for p in parts)
        nodes = out.split(nodes, *best_splits(hist, open_, s), last=level == s.depth)
        if not len(nodes):
            break
    return out.pruned()


class Stopping:
    """Losses on the rows kept aside; stops once ``patience`` rounds have brought nothing better."""

    def __init__(self, s: Spec):
        self.spec, self.best, self.at, self.seen = s, np.inf, 0, 0

    def over(self, loss: float | None) -> bool:
        """Takes the loss after another tree; without rows kept aside every tree counts."""
        self.seen += 1
        if loss is None:
            self.at = self.seen
        elif loss < self.best:
            self.best, self.at = loss, self.seen
        return self.seen >= self.spec.trees or self.seen - self.at >= self.spec.patience


def log_loss(margin: np.ndarray, y: np.ndarray, count: np.ndarray) -> float:
    return float((count * (np.logaddexp(0, margin) - y * margin)).sum())


def grouped(bins, y, w, h, aside) -> tuple:
    """Bins (a row per feature), label and weight of each group, those kept aside last; all hashes, each group's start, the groups learned from."""
    order, start = groups_of(bins, aside.astype(np.int64), y.astype(np.int64), np.unique(w, return_inverse=True)[1])
    first = order[start]
    return np.ascontiguousarray(bins[:, first]), y[first], w[first], h[order], start, int((~aside[first]).sum())


def fit_rows(bins, y, w, h, aside, s: Spec, width: int) -> list[Tree]:
    """All trees of one fit. Rows in ``aside`` only decide when boosting stops; forests learn from them too."""
    bins, y, w, h, start, n = grouped(bins.T, y, w, h, np.zeros(len(y), bool) if s.forest else aside)
    if s.forest:
        return [grow(bins.T, y, w, h, np.zeros(len(y)), t, s, width, start) for t in range(s.trees)]
    trees, margin, stop = [], np.zeros(len(y)), Stopping(s)
    if not n:
        return []
    sizes = rows_of(h, start)
    learned = h if n == len(y) else h[: start[n]]
    for t in range(s.trees):
        tree = grow(bins.T[:n], y[:n], w[:n], learned, margin[:n], t, s, width, start[:n])
        trees.append(tree)
        for p in blocks_of(len(y)):
            margin[p] += s.rate * tree.values(bins[:, p])
        if stop.over(log_loss(margin[n:], y[n:], sizes[n:]) if n < len(y) else None):
            break
    return trees[: stop.at]


# ---- tables -----------------------------------------------------------------------
def cut_points(df: DataFrame, features: Sequence[str], bins: int = 64) -> list[np.ndarray]:
    """At most ``bins`` - 1 cut points per feature, at equal shares of its values; nulls and NaN count as 0."""
    shares_ = [i / bins for i in range(1, bins)]
    row = df.agg(*(F.percentile_approx(_number(f), shares_, 10_000).alias(f"_{i}") for i, f in enumerate(features))).first()
    return [np.unique(np.array(v if v is not None else [], np.float64)) for v in row]


def _number(name: str):
    return F.coalesce(F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(0.0)), F.lit(0.0))


def counted(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], by: Sequence[str], *more) -> DataFrame:
    """(*by, *features, _n, *more): rows between the same cuts of every feature are one cell with the number of its rows.

    Its features are numbers between those cuts, so that trees that split there see a cell as they see its rows. ``more`` are
    further aggregates.
    """
    rows = df.select(*(F.col(f"`{c}`") for c in by), *[c for c in df.columns if c not in (*by, *features)], *(_number(f).alias(f"_v{i}") for i, f in enumerate(features)))
    values = []
    for i, c in enumerate(cuts):
        above = np.nextafter(np.asarray(c, np.float64), inf)  # a cut is on the side of the values below it
        edges = above[np.isfinite(above)]
        if len(edges):
            rows = Bucketizer(splits=[-inf, *map(float, edges), inf], inputCol=f"_v{i}", outputCol=f"_c{i}").transform(rows)
            values.append(F.element_at(F.array(*(F.lit(float(v)) for v in (*c[: len(edges)], edges[-1]))), F.col(f"_c{i}").cast("int") + 1))
        else:
            rows = rows.withColumn(f"_c{i}", F.lit(0.0))
            values.append(F.lit(0.0))
    cells = rows.groupBy(*(F.col(f"`{c}`") for c in by), *(f"_c{i}" for i in range(len(features)))).agg(F.count("*").alias("_n"), *more)
    return cells.select(*(F.col(f"`{c}`") for c in by), *(v.alias(f) for f, v in zip(features, values, strict=True)), *cells.columns[len(by) + len(features):])


def cuts_of(models: DataFrame, n: int) -> list[np.ndarray]:
    """Where the trees of all models split each of ``n`` features: at no more places than their cut points."""
    each = models.select(F.inline(F.arrays_zip("feature", "cut"))).where("feature >= 0").groupBy("feature").agg(F.collect_set("cut").alias("cuts"))
    found = {r["feature"]: np.unique(r["cuts"]) for r in each.collect()}
    return [found.get(f, np.array([])) for f in range(n)]


def _models_schema() -> str:
    return ("_set long, _candidate string, _features int, feature array<int>, cut array<double>, value array<double>, gain array<double>, "
            "cover array<double>, rows array<double>")


def _model_row(set_, name: str, trees: list[Tree], cuts: list[np.ndarray], n: int) -> dict:
    def all_(k):
        return np.concatenate([getattr(t, k) for t in trees]).tolist() if trees else []
    at = [float(cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(all_("feature"), all_("cut"), strict=True)]
    return {"_set": int(set_), "_candidate": name, "_features": n, "feature": all_("feature"), "cut": at,
            **{k: all_(k) for k in ("value", "gain", "cover", "rows")}}


def fit_many(
    rows: DataFrame, features: Sequence[str], label: str, candidates: Mapping[str, Spec], *, set_: str = "_set", weight: str = "weight",
    aside: str = "_aside", spot: str = "_spot", bins: int = 64, task_bytes: int = TASK_BYTES, cuts: list[np.ndarray] | None = None,
) -> DataFrame:
    """One model per set of ``rows`` and candidate, settled.

    ``rows`` has one row per row and set: the set, label 0 or 1, features, weight, whether it is kept aside, and a hash of
    its key (``spot``); all random choices follow the least of a cell. Rows without a label are left out. A set without rows has no model.
    """
    import pyarrow as pa
    cuts = cuts or cut_points(rows, features, bins)
    width, n = max(2, max(len(c) for c in cuts) + 1), len(features)

    def binned(batches):
        held: dict = {}
        def block(s):
            parts = held.pop(s)
            x, y, w, h = np.concatenate([p[0] for p in parts], 1), *(np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(s)]), pa.array([len(y)]), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (x, y, w, h))],
                names=["_set", "_rows", "_bins", "_y", "_w", "_h"])
        for batch in batches:
            column = lambda i: batch.column(i).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            x, h = np.stack([np.searchsorted(c, column(6 + i), "left").astype(kind) for i, c in enumerate(cuts)]), np.stack([column(4), column(5)], 1)
            y = column(1).astype(np.uint8) | (column(3).astype(np.uint8) << 7)
            of, order = np.unique(column(0), return_inverse=True)
            order, ends = np.argsort(order, kind="stable"), np.cumsum(np.bincount(order, minlength=len(of)))
            for s, at in zip(of, np.split(order, ends[:-1]), strict=True):
                for p in blocks_of(len(at)):
                    held.setdefault(s, []).append((x[:, at[p]], y[at[p]], column(2)[at[p]], h[at[p]]))
                    if sum(len(v[1]) for v in held[s]) >= BLOCK_ROWS:
                        yield block(s)
        for s in list(held):
            yield block(s)

    kind = np.uint8 if width <= 256 else np.uint16
    numbers = [f"_{i}" for i in range(n)]
    single = rows.where(F.col(label).isNotNull()).select(
        F.col(set_).cast("long").alias("_set"), F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"),
        F.col(aside).alias("_aside"), F.col(spot).cast("long").alias("_h"), *(_number(f).alias(i) for f, i in zip(features, numbers, strict=True)))
    cells = counted(single, numbers, cuts, ["_set", "_y", "_w", "_aside"], F.min("_h").alias("_h"))
    packed = settled(cells.select("_set", "_y", "_w", "_aside", "_h", "_n", *numbers).mapInArrow(binned, _BLOCKS))
    sizes = {r[0]: r[1] for r in packed.groupBy("_set").agg(F.sum("_rows")).collect()}  # cells of a set
    if not sizes:
        return rows.sparkSession.createDataFrame([], _models_schema())
    # forests grow many trees in a pass over all tasks: with far fewer fits than tasks that is sooner worth its jobs
    waiting = max(1, rows.sparkSession.sparkContext.defaultParallelism / 4) if all(c.forest for c in candidates.values()) else 1
    if max(sizes.values()) * (n + 48) > task_bytes * min(1, len(sizes) * len(candidates) / waiting):
        return _fit_in_levels(packed, sizes, candidates, cuts, width, n, kind)

    def one(table):
        blocks = [arrays(b, n, kind) for b in table.to_pylist()]
        bins, (y, w, h, aside) = np.concatenate([b[0] for b in blocks], 1), (np.concatenate([b[i] for b in blocks]) for i in (1, 2, 3, 4))
        trees = fit_rows(bins.T, y, w, h, aside, candidates[table["_candidate"][0].as_py()], width)
        return pa.Table.from_pylist([_model_row(table["_set"][0].as_py(), table["_candidate"][0].as_py(), trees, cuts, n)], schema=_arrow_schema())

    dealt = packed.withColumn("_candidate", F.explode(F.array(*map(F.lit, candidates))))
    # a stated number of tasks: the cells are few, so that adaptive execution would put all fits into one; many more than fits, so
    # that large ones seldom share a task
    fits = len(sizes) * len(candidates)
    dealt = dealt.repartition(max(fits, min(16 * fits, 512)) if fits < 512 else 512, "_set", "_candidate")
    # a task per fit writes a model or two, which few tasks read
    return settled(dealt.groupBy("_set", "_candidate").applyInArrow(one, _models_schema())).coalesce(rows.sparkSession.sparkContext.defaultParallelism)


#: Cells of one set: bins feature by feature, label and whether kept aside in a byte, weights, hashes and numbers of rows.
_BLOCKS = "_set long, _rows long, _bins binary, _y binary, _w binary, _h binary"


def _arrow_schema():
    import pyarrow as pa
    numbers = pa.list_(pa.float64())
    return pa.schema([("_set", pa.int64()), ("_candidate", pa.string()), ("_features", pa.int32()), ("feature", pa.list_(pa.int32())),
                      *((k, numbers) for k in ("cut", "value", "gain", "cover", "rows"))])


def arrays(block: Mapping, n: int, kind):
    """Bins (a row per feature), labels, weights, hashes with numbers of rows, and the cells kept aside of a block."""
    y = np.frombuffer(block["_y"], np.uint8)
    return (np.frombuffer(block["_bins"], kind).reshape(n, -1), (y & 127).astype(np.float64), np.frombuffer(block["_w"]),
            np.frombuffer(block["_h"], np.uint64).reshape(-1, 2), y > 127)


def _fit_in_levels(packed: DataFrame, sizes: Mapping[int, int], candidates: Mapping[str, Spec], cuts, width: int, n: int, kind) -> DataFrame:
    """All fits side by side: a job per level adds up their histograms and finds the splits; margins are stored now and then."""
    import pyarrow as pa
    spark = packed.sparkSession
    names, boosted = list(candidates), [c for c, spec in candidates.items() if not spec.forest]
    trees: dict = {(s, c): [] for s in sizes for c in names}
    stops = {k: Stopping(candidates[k[1]]) for k in trees}
    live = {k for k in trees}
    stored = {k: 0 for k in trees}
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) // SHARE_ROWS))
    schema = f"{_BLOCKS}, _start binary, _learned long, _margins binary"

    def put_together(batches):
        """Blocks of groups from a task's blocks of rows: the more rows of a set meet, the fewer groups they are."""
        held: dict = {}
        def groups(s):
            parts = held.pop(s)
            bins, *more = np.concatenate([b[0] for b in parts], 1), *(np.concatenate([b[i] for b in parts]) for i in (1, 2, 3, 4))
            bins, y, w, h, start, learned = grouped(bins, *more)
            y = y.astype(np.uint8) | (np.arange(len(y)) >= learned).astype(np.uint8) << 7
            return pa.RecordBatch.from_arrays(
                [pa.array([s]), pa.array([len(h)]), *(pa.array([v.tobytes()], pa.binary()) for v in (bins, y, w, h, start)), pa.array([learned]), pa.array([b""], pa.binary())],
                names=[c.split()[0] for c in schema.split(", ")])
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                held.setdefault(block["_set"], []).append(arrays(block, n, kind))
                if sum(len(b[1]) for b in held[block["_set"]]) >= SHARE_ROWS:
                    yield groups(block["_set"])
        for s in list(held):
            yield groups(s)

    def advanced(block, sent):
        """The arrays of a block and its margins (candidate, group) after the trees that are not in the stored ones yet."""
        x = (*arrays(block, n, kind)[:4], np.frombuffer(block["_start"], np.int64))
        margins = np.frombuffer(block["_margins"]).reshape(len(boosted), -1).copy() if block["_margins"] else np.zeros((len(boosted), len(x[1])))
        for j, c in enumerate(boosted):
            for t in sent["new"].get((block["_set"], c), ()):
                for p in blocks_of(len(x[1])):
                    margins[j, p] += candidates[c].rate * t.values(x[0][:, p])
        return x, margins

    def sums(sent):
        def run(batches: Iterator[pa.RecordBatch]):
            held: dict = {}
            def add(key, one):
                held[key] = held[key] + one if key in held else one
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.slice(i, 1).to_pylist()[0]
                    s = block["_set"]
                    (bins, y, w, h, start), margins = advanced(block, sent)
                    k, none = block["_learned"], np.zeros(len(y))
                    learned = h if k == len(y) else h[: start[k]]
                    for c in names:
                        spec, j = candidates[c], boosted.index(c) if c in boosted else None
                        for number, tree, nodes in sent["units"].get((s, c), ()):
                            if not spec.forest and not k:
                                continue
                            own = (bins, y, w, h, start, none) if spec.forest else (bins[:, :k], y[:k], w[:k], learned, start[:k], margins[j, :k])
                            open_ = open_features(number, nodes, n, spec)
                            for part in drawn_parts(*own, number, spec):
                                add((s, c, number), level_sums(part, tree, nodes, sent["level"], width, open_))
                        if (s, c) in sent["losses"] and k < len(y):
                            add((s, c, -1), np.array([log_loss(margins[j, k:], y[k:], rows_of(h, start)[k:])]))
            for k, v in held.items():
                yield pa.RecordBatch.from_pylist([{"_set": k[0], "_candidate": k[1], "_tree": k[2], "_sums": v.tobytes()}], schema=pa.schema([
                    ("_set", pa.int64()), ("_candidate", pa.string()), ("_tree", pa.int64()), ("_sums", pa.binary())]))
        return run

    def decided(s, c, number, parts, units) -> dict:
        total = sum(np.frombuffer(v) for v in parts)
        row = {"_set": s, "_candidate": c, "_tree": number, "_loss": float(total[0]), **dict.fromkeys(("_feature", "_cut", "_gain", "_total", "_left"))}
        if number >= 0:
            nodes = next(u[2] for u in units[s, c] if u[0] == number)
            found = best_splits(total.reshape(len(nodes), n, width, 3), open_features(number, nodes, n, candidates[c]), candidates[c])
            row |= {k: v.ravel().tolist() for k, v in zip(("_feature", "_cut", "_gain", "_total", "_left"), found, strict=True)}
        return row

    def passed(units: dict, losses: set, level: int) -> list:
        new = {k: v[stored[k]:] for k, v in trees.items() if len(v) > stored[k] and not candidates[k[1]].forest}
        partial = state.mapInArrow(sums({"new": new, "units": units, "losses": losses, "level": level}), "_set long, _candidate string, _tree long, _sums binary")
        if tasks * sum(len(u[2]) for of in units.values() for u in of) * n * width * 24 <= SUMS_BYTES:
            parts: dict = {}
            for r in partial.collect():  # at most SUMS_BYTES
                parts.setdefault((r["_set"], r["_candidate"], r["_tree"]), []).append(r["_sums"])
            return [decided(*k, v, units) for k, v in parts.items()]

        def merged(table):
            one = decided(*(table[k][0].as_py() for k in ("_set", "_candidate", "_tree")), (v.as_py() for v in table["_sums"]), units)
            return pa.Table.from_pylist([one], schema=pa.schema([
                ("_set", pa.int64()), ("_candidate", pa.string()), ("_tree", pa.int64()), ("_loss", pa.float64()), ("_feature", pa.list_(pa.int64())),
                ("_cut", pa.list_(pa.int64())), *((k, pa.list_(pa.float64())) for k in ("_gain", "_total", "_left"))]))

        return partial.groupBy("_set", "_candidate", "_tree").applyInArrow(
            merged, "_set long, _candidate string, _tree long, _loss double, _feature array<long>, _cut array<long>, _gain array<double>, "
            "_total array<double>, _left array<double>").collect()  # a row a tree

    def stopped(found: list, asked: set) -> None:
        losses = {(r["_set"], r["_candidate"]): r["_loss"] for r in found if r["_tree"] < 0}
        for k in asked:
            if stops[k].over(losses.get(k)):
                trees[k] = trees[k][: stops[k].at]
                live.discard(k)

    # a task's blocks are of one set, or of two next to each other, so that as many equal rows as possible meet
    state = settled(packed.repartitionByRange(tasks, "_set", F.xxhash64("_h")).mapInArrow(put_together, schema))
    asked: set = set()  # fits whose last tree has not been judged yet
    while live:
        units = {}
        for k in sorted(live):
            spec = candidates[k[1]]
            numbers = range(len(trees[k]), min(spec.trees, len(trees[k]) + TREES_AT_ONCE)) if spec.forest else [len(trees[k])]
            units[k] = [(i, Tree(spec), np.zeros(1, np.int64)) for i in numbers if i < spec.trees]
        grown = {k: [t for _, t, _ in u] for k, u in units.items()}
        level = 0
        while any(units.values()) or asked:
            found = passed(units, asked, level)
            stopped(found, asked)
            asked = set()
            at = {(r["_set"], r["_candidate"], r["_tree"]): r for r in found}
            for k, of in units.items():
                after = []
                for number, tree, nodes in of if k in live else ():
                    r, depth = at.get((*k, number)), candidates[k[1]].depth
                    if r is None:  # a draw without any row
                        continue
                    nodes = tree.split(nodes, *(np.array(r[c]) for c in ("_feature", "_cut", "_gain")), *(np.array(r[c]).reshape(-1, 3) for c in ("_total", "_left")), last=level == depth)
                    if len(nodes) and level + 1 < depth:
                        after.append((number, tree, nodes))
                units[k] = after
            level += 1
        for k in sorted(live):
            trees[k] += [t.pruned() for t in grown[k]]
            if candidates[k[1]].forest:
                live -= {k} if len(trees[k]) >= candidates[k[1]].trees else set()
            else:
                asked.add(k)
        if asked and max(len(trees[k]) - stored[k] for k in asked) >= ROUNDS_STORED:
            sent = {"new": {k: trees[k][stored[k]:] for k in asked}}
            def store(batches, sent=sent):
                for batch in batches:
                    for i in range(batch.num_rows):
                        one = batch.slice(i, 1)
                        margins = advanced(one.to_pylist()[0], sent)[1]
                        yield pa.RecordBatch.from_arrays([*one.columns[:-1], pa.array([margins.tobytes()], pa.binary())], names=batch.schema.names)
            state = settled(state.mapInArrow(store, schema))
            stored |= {k: len(trees[k]) for k in asked}
    models = [_model_row(k[0], k[1], v, cuts, n) for k, v in trees.items()]
    return settled(spark.createDataFrame([tuple(m.values()) for m in models], _models_schema()))


class TreeModel:
    """One model on the driver, its size set by its parameters."""

    def __init__(self, row, spec: Spec):
        self.spec, self.features, self._terms = spec, row["_features"], None
        self.feature, self.cut, self.value, self.gain, self.cover, self.rows = (
            np.array([] if row[k] is None else row[k], t).reshape(-1, spec.size) for k, t in (
                ("feature", np.int64), ("cut", np.float64), ("value", np.float64), ("gain", np.float64), ("cover", np.float64), ("rows", np.float64)))

        # a row's comparisons with cuts, of any model, follow from its bins between the cuts of each feature
        self.cuts = [np.unique(self.cut[self.feature == f]) for f in range(self.features)]
        self._held = None
        self.place = np.zeros(self.cut.shape, np.int64)
        for f, cuts in enumerate(self.cuts):
            self.place[self.feature == f] = np.searchsorted(cuts, self.cut[self.feature == f])

    def slim(self) -> TreeModel:
        """With no more than scores need, in few bytes."""
        kind = np.int16 if max(map(len, self.cuts), default=0) < 1 << 15 else np.int32
        self.feature, self.place = self.feature.astype(np.int16), self.place.astype(kind)
        self.cut = self.gain = self.cover = self.rows = None
        return self

    def bins(self, x: np.ndarray) -> np.ndarray:
        """(feature, row): how many of a feature's cuts lie below a value, none for NaN."""
        kind = np.uint8 if max(map(len, self.cuts), default=0) < 256 else np.uint32
        return np.stack([np.searchsorted(c, np.where(np.isnan(v), -np.inf, v), "left").astype(kind) for c, v in zip(self.cuts, x.T)]) if self.cuts else np.zeros((0, len(x)), kind)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' values in boosting, their mean in a forest.

        Rows between the same cuts of every feature have the same; if such cells are few, each is worked out once.
        """
        total, sizes = np.zeros(len(x)), [len(c) + 1 for c in self.cuts]
        values = [v[reached(f, self.spec.depth)] for f, v in zip(self.feature, self.value, strict=True)]
        if not sizes or prod(sizes) > SCORE_CELLS:
            for p in blocks_of(len(x)):
                total[p] = self._sums(self.bins(x[p]), values)
        else:
            if self._held is None:
                self._held = np.zeros(prod(sizes), bool), np.zeros(prod(sizes))
            known, found = self._held
            for p in blocks_of(len(x)):
                bins = self.bins(x[p])
                at = np.ravel_multi_index(tuple(bins.astype(np.int64)), sizes)
                new, first = np.unique(at, return_index=True)
                first = first[~known[new]]
                found[at[first]], known[at[first]] = self._sums(np.ascontiguousarray(bins[:, first]), values), True
                total[p] = found[at]
        return total / max(1, len(self.feature)) if self.spec.forest else total * self.spec.rate

    def _sums(self, bins: np.ndarray, values: list) -> np.ndarray:
        out = np.zeros(bins.shape[1])
        for f, c, v in zip(self.feature, self.place, values, strict=True):
            out += v[paths(bins, f, c, self.spec.depth)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        m = self.margins(x)
        return np.clip(m, 0, 1) if self.spec.forest else 1 / (1 + np.exp(-m))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """(row, feature + 1): path-dependent Shapley values of the margin; the last column is the margin without any feature.

        Per leaf, a feature of its path either leads there or not, so that a row meets one of 2 ** d patterns of the path's d
        features; what each pattern adds to each feature is computed once per leaf, whatever the number of rows.
        """
        out, terms = np.zeros((len(x), self.features + 1)), self.terms()
        out[:, -1] = sum(value * z.prod() for _, _, _, value, z, _ in terms)
        for p in blocks_of(len(x)):
            bins = self.bins(x[p])
            to = np.zeros((self.features, bins.shape[1]))
            for names, low, high, _, _, added in terms:
                pattern = np.zeros(bins.shape[1], np.uint8 if len(names) <= 8 else np.uint32)
                for i, k in enumerate(names):
                    pattern |= ((bins[k] >= low[i]) & (bins[k] <= high[i])).astype(pattern.dtype) << pattern.dtype.type(i)
                for i, k in enumerate(names):
                    to[k] += added[i][pattern]
            out[p, :-1] = to.T
        return out

    def terms(self) -> list:
        """Per leaf: its path's features, their first and last bin that lead there, value, shares z, and what patterns add (feature, pattern)."""
        if self._terms is None:
            scale = 1 / max(1, len(self.feature)) if self.spec.forest else self.spec.rate
            found: list = []
            for f, c, v, cover in zip(self.feature, self.place, self.value, self.cover, strict=True):
                for leaf in np.flatnonzero(f == _LEAF):
                    path, node = [], int(leaf)
                    while node:
                        parent = (node - 1) // 2
                        share = cover[node] / cover[parent] if cover[parent] > 0 else 0.5
                        path.append((int(f[parent]), int(c[parent]), node == 2 * parent + 2, share))
                        node = parent
                    names = sorted({p[0] for p in path})
                    low = [max((p[1] + 1 for p in path if p[0] == k and p[2]), default=0) for k in names]
                    high = [min((p[1] for p in path if p[0] == k and not p[2]), default=len(self.cuts[k])) for k in names]
                    found.append((names, low, high, scale * v[leaf], np.array([np.prod([p[3] for p in path if p[0] == k]) for k in names])))
            self._terms = []
            for d in sorted({len(t[0]) for t in found}):
                same = [t for t in found if len(t[0]) == d]
                for a in range(0, len(same), 256):
                    some = same[a: a + 256]
                    added = shapley_patterns(np.array([t[4] for t in some]).reshape(len(some), d)).transpose(0, 2, 1)
                    self._terms += [(*t, np.ascontiguousarray(t[3] * one)) for t, one in zip(some, added, strict=True)]
        return self._terms


def shapley_patterns(z: np.ndarray) -> np.ndarray:
    """(..., pattern, feature) from shares (..., feature): Shapley values of the game prod(o_i if i is known else z_i), for every pattern of 0 and 1 in o."""
    d = z.shape[-1]
    o = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    out = np.zeros((*z.shape[:-1], 1 << d, d))
    weights = [factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)]
    for i in range(d):
        # polynomial in the number of known features among the others
        poly = [np.ones((*z.shape[:-1], 1 << d))]
        for j in range(d):
            if j != i:
                grown = [p * z[..., None, j] for p in poly] + [0.0]
                poly = [g + (poly[k - 1] * o[:, j] if k else 0.0) for k, g in enumerate(grown)]
        out[..., i] = (o[:, i] - z[..., None, i]) * sum(w * p for w, p in zip(weights, poly, strict=True))
    return out


def model_of(models: DataFrame, set_: int, name: str, spec: Spec) -> TreeModel:
    """The model of one fit; a fit without rows scores 0.5."""
    row = models.where((F.col("_set") == set_) & (F.col("_candidate") == name)).first()
    return TreeModel(row or {"_features": 0, **dict.fromkeys(("feature", "cut", "value", "gain", "cover", "rows"))}, spec)


def _matrix(batch, first: int, n: int) -> np.ndarray:
    return np.column_stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(n)]) if n else np.zeros((batch.num_rows, 0))


def _gathered(batches, rows: int = 4 * BLOCK_ROWS):
    """Batches put together to about ``rows`` rows, as each model has its cost per batch."""
    import pyarrow as pa
    held: list = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def scored_by(df: DataFrame, model: TreeModel, features: Sequence[str], out: str = "pred_prob") -> DataFrame:
    """The rows with the probability of label 1; an existing column ``out`` is replaced."""
    import pyarrow as pa
    kept = [c for c in df.columns if c != out]
    numbers = [f"_feature_{i}" for i in range(len(features))]

    def run(batches):
        for batch in _gathered(batches):
            p = model.probabilities(_matrix(batch, len(kept), len(features)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(p)], names=[*kept, out])

    rows = df.select(*(F.col(f"`{c}`") for c in kept), *(_number(f).alias(n) for f, n in zip(features, numbers, strict=True)))
    return rows.mapInArrow(run, df.select(*(F.col(f"`{c}`") for c in kept)).schema.add(out, "double"))


def score_many(rows: DataFrame, models: DataFrame, features: Sequence[str], candidates: Mapping[str, Spec], keep: Sequence[str], out: str = "pred_prob") -> DataFrame:
    """(*keep, _set, _candidate, score) of every row under each candidate's model of its set.

    Models go out in parts of about ``MODEL_BYTES``. Rows meet those of their set, so that a task opens few models and applies
    them to many rows each.
    """
    import pyarrow as pa
    size = models.agg(F.sum(F.size("feature").cast("long") * SLIM_BYTES)).first()[0] or 0
    parts, done = max(1, -(-int(size) // MODEL_BYTES)), None
    schema = rows.select(*(F.col(f"`{c}`") for c in keep), F.col("_set").cast("long").alias("_set")).schema.add("_candidate", "string").add(out, "double")
    numbers = [_number(f).alias(f"_f{i}") for i, f in enumerate(features)]
    near = rows.select(*(F.col(f"`{c}`") for c in keep), F.col("_set").cast("long").alias("_set"), *numbers)
    near = near.repartitionByRange(4 * rows.sparkSession.sparkContext.defaultParallelism, "_set", F.xxhash64(*(f"_f{i}" for i in range(len(features))))).sortWithinPartitions("_set")
    needed = models.withColumns({k: F.array().cast("array<double>") for k in ("gain", "cover", "rows")})
    for part in range(parts):
        sent = {}
        found = needed.where(F.pmod(F.xxhash64("_set", "_candidate"), F.lit(parts)) == part).toArrow()  # about MODEL_BYTES once slim
        for i, (s, name) in enumerate(zip(found["_set"].to_pylist(), found["_candidate"].to_pylist(), strict=True)):
            row = {k: found[k][i].as_py() if k == "_features" else found[k][i].values.to_numpy() for k in found.column_names[2:]}
            sent.setdefault(s, []).append((name, TreeModel(row, candidates[name]).slim()))
        sent = {s: pickle.dumps(models_) for s, models_ in sent.items()}

        def run(batches, sent=sent):
            last, own = None, ()
            for batch in _gathered(batches):
                of, x = batch.column(len(keep)).to_numpy(), _matrix(batch, len(keep) + 1, len(features))
                for s in np.unique(of):  # ascending, and over before the next begins
                    if s != last:
                        last, own = s, pickle.loads(sent[s]) if s in sent else ()
                    at = np.flatnonzero(of == s)
                    columns = [c.take(pa.array(at)) for c in batch.columns[: len(keep) + 1]]
                    for name, model in own:
                        yield pa.RecordBatch.from_arrays(
                            [*columns, pa.array([name] * len(at), pa.string()), pa.array(model.probabilities(x[at]))], names=[*keep, "_set", "_candidate", out])

        one = near.mapInArrow(run, schema)
        done = one if done is None else done.unionByName(one)
    return done


def contributions(df: DataFrame, model: TreeModel, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(*keys, base, margin, one column per feature): what each feature adds to a row's margin; base and features sum to it."""
    import pyarrow as pa
    names = ["base", "margin", *features]

    def run(batches):
        for batch in _gathered(batches):
            x = _matrix(batch, len(keys), len(features))
            c = model.contributions(x)
            columns = [c[:, -1], model.margins(x), *c.T[:-1]] if model.features else [np.zeros(len(x))] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *(pa.array(v) for v in columns)], names=[*keys, *names])

    rows = df.select(*(F.col(f"`{k}`") for k in keys), *(_number(f).alias(f"_f{i}") for i, f in enumerate(features)))
    schema = df.select(*(F.col(f"`{k}`") for k in keys)).schema
    for name in names:
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def mean_contributions(df: DataFrame, model: TreeModel, features: Sequence[str], keys: Sequence[str], top: int = 15) -> DataFrame:
    """(feature, mean_abs, rank): the ``top`` features by their mean absolute contribution over all rows."""
    found = contributions(df, model, features, keys)
    means = found.agg(*(F.avg(F.abs(F.col(f"`{f}`"))).alias(f"_{i}") for i, f in enumerate(features)))
    long = means.select(F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"_{i}").alias("mean_abs")) for i, f in enumerate(features)))))
    return long.selectExpr("*", "row_number() over (order by mean_abs desc, feature) as rank").where(F.col("rank") <= top)  # a row a feature

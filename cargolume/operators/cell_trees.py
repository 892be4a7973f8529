"""Trees learnt from counts of like rows: all rows of a fit, however many, in the memory that its cells take.

Rows of one cell and label cannot be told apart by a tree, so a fit of any size is its cells with two counts each: rows on
time and late rows. What single rows would give is drawn from the counts with the same chances: how often a bootstrap
takes them, and which inner fold they are dealt to. Sums are whole numbers and exact.
"""

import hashlib
import math
import zlib

import numpy as np

from cargolume.schemas import NUMERIC_FEATURES

BINS = 32
PACKED = 17  # bits of a count, where three of them share one number
DEAL_ROWS = 500_000_000  # rows that are dealt to folds at once; numpy draws from less than 10^9


def packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<i8").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i8").astype(np.int64)


def mark(cells: np.ndarray, on_time: np.ndarray, late: np.ndarray) -> str:
    """A digest of what a fit learns from; cells are in rising order."""
    return hashlib.sha256(b"".join(a.astype("<i8").tobytes() for a in (cells, on_time, late))).hexdigest()[:32]


def dealt(counts: np.ndarray, folds: int, rng) -> list[np.ndarray]:
    """The rows of every fold: each row lies in one fold, folds are as even as they can be, every dealing is as likely."""
    ends = np.cumsum(counts)
    block = (ends - counts) // DEAL_ROWS
    out = [np.zeros_like(counts) for _ in range(folds)]
    for b in np.unique(block):
        own = block == b
        rest, rows = counts[own].copy(), int(counts[own].sum())
        for i in range(folds):
            some = rng.multivariate_hypergeometric(rest, (rows - i + folds - 1) // folds, method="marginals") if i < folds - 1 else rest
            out[i][own] = some
            rest = rest - some
    return out


def taken(counts: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """How often the rows of every cell are taken in all, and how many of them at all, when each is taken Poisson(1) times.

    Of the rows taken at least k times those taken once more are drawn, until none is left.
    """
    total, rows = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    at = np.flatnonzero(counts)
    left, k, chance, tail = counts[at], 0, math.exp(-1), 1.0  # chance of k times, and of k or more
    while len(at):
        tail, above = tail - chance, tail
        left = rng.binomial(left, max(tail, 0.0) / above)
        at, left = at[left > 0], left[left > 0]
        total[at] += left
        if k == 0:
            rows[at] = left
        k += 1
        chance /= k
    return total, rows


class _Sums:
    """Counts (taken on time, taken late, rows) of the entries of a level, added up by key; one pass where they are small."""

    def __init__(self, *parts):
        self.parts = [np.asarray(p, np.int64) for p in parts]
        self.one = None

    def pack(self):
        a, b, c = self.parts
        self.one, self.parts = (a + (b << PACKED) + (c << 2 * PACKED)).astype(float), None

    def keep(self, on):
        if self.one is not None:
            self.one = self.one[on]
        else:
            self.parts = [p[on] for p in self.parts]

    def by(self, key, chosen, size) -> list[np.ndarray]:
        if self.one is None:
            return [np.bincount(key, p[chosen], size).astype(np.int64) for p in self.parts]
        s, low = np.bincount(key, self.one[chosen], size).astype(np.int64), (1 << PACKED) - 1
        return [s & low, s >> PACKED & low, s >> 2 * PACKED]


def _gain(left: list, whole: list, weight: tuple, min_leaf: int) -> np.ndarray:
    """Drop of the weighted Gini index; minus infinity where a side has too few rows."""
    def purity(t, late):
        t, late = t * weight[0], late * weight[1]
        return (t**2 + late**2) / (t + late)

    right = [w - a for w, a in zip(whole, left)]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = purity(*left[:2]) + purity(*right[:2]) - purity(*whole[:2])
    return np.where((left[2] >= min_leaf) & (right[2] >= min_leaf) & (gain > 1e-9), gain, -np.inf)


def grow(x: np.ndarray, on_time: np.ndarray, late: np.ndarray, weight: tuple, depth: int, min_leaf: int, usable: np.ndarray, rng) -> tuple:
    """One tree as (feature, bin, left, value, importance), as `forest.grow` makes them from single rows.

    `x`: slot values of the cells. `weight`: of a row on time and of a late one. A level's nodes are split together; the
    counts of a child are those of its side of the split.
    """
    k, slots, flat = max(1, math.isqrt(len(usable))), x.shape[1], x.ravel()
    (t0, d0), (t1, d1) = taken(on_time, rng), taken(late, rng)
    row = np.flatnonzero(d0 + d1)
    sums, at, node = _Sums(t0[row], t1[row], (d0 + d1)[row]), row * slots, np.zeros(len(row), np.int64)
    total = [np.array([p.sum()]) for p in sums.parts]
    feature, bins, left, value, gained, made = [], [], [], [], np.zeros(slots), 1
    for level in range(depth + 1):
        m = len(total[0])
        value.append(total[1] * weight[1] / np.maximum(total[0] * weight[0] + total[1] * weight[1], 1e-300))
        open_ = (total[0] > 0) & (total[1] > 0) & (total[2] >= 2 * min_leaf) & (level < depth)
        here = np.flatnonzero(open_)
        if len(here) < m:
            on = open_[node]
            node, at = (np.cumsum(open_) - 1)[node[on]], at[on]
            sums.keep(on)
        whole = [t[here] for t in total]
        if sums.one is None and len(here) and (whole[0] + whole[1]).max() < 1 << PACKED:
            sums.pack()
        drawn = usable[rng.random((len(here), len(usable))).argsort(1)]
        which, cut, best, side = _split(flat, at, node, sums, whole, weight, drawn, k, min_leaf)
        split = which >= 0
        spot = np.full(m, -1)
        spot[here] = which
        feature.append(spot)
        bins.append(np.zeros(m, np.int64))
        bins[-1][here] = cut
        left.append(np.zeros(m, np.int64))
        left[-1][here[split]] = made + 2 * np.arange(int(split.sum()))
        if not split.any():
            break
        gained += np.bincount(which[split], best[split], slots)
        made += 2 * int(split.sum())
        on = split[node]
        node, at = node[on], at[on]
        sums.keep(on)
        node = 2 * (np.cumsum(split) - 1)[node] + (flat[at + which[node]] > cut[node])
        total = [np.stack([a[split], (w - a)[split]], 1).ravel() for a, w in zip(side, whole)]
    feature, bins, left, value = map(np.concatenate, (feature, bins, left, value))
    return feature.astype(np.int8), bins.astype(np.uint8), left.astype(np.int32), value.astype(np.float32), gained / gained.sum() if gained.sum() > 0 else gained


def _split(flat, at, node, sums, whole, weight, drawn, k, min_leaf) -> tuple:
    """Slot, bin and gain of every node's best split (slot -1: none), and the counts on its left.

    A node looks at `k` drawn slots, and on at more while none splits it. The first drawn of equal slots wins, the lowest
    of equal bins.
    """
    n = len(drawn)
    which, cut, best = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -np.inf)
    side = [np.zeros(n, np.int64) for _ in whole]
    entry = np.arange(len(node))
    for j in range(drawn.shape[1]):
        todo = which < 0 if j >= k else np.ones(n, bool)
        if not todo.any():
            break
        if j >= k:  # those that something has split do not come back
            entry = entry[todo[node[entry]]]
        own, slot = node[entry], drawn[:, j]
        v, number = flat[at[entry] + slot[own]], (slot < len(NUMERIC_FEATURES)) & todo
        one = np.flatnonzero((v == 1) & ~number[own])  # yes or no: the noes are the rest
        a = [w - c for w, c in zip(whole, sums.by(own[one], entry[one], n))]
        gain = _gain(a, whole, weight, min_leaf)
        won = np.flatnonzero((gain > best) & todo & ~number)
        best[won], which[won], cut[won] = gain[won], slot[won], 0
        for s, c in zip(side, a):
            s[won] = c[won]
        here = np.flatnonzero(number)
        if len(here):
            some = np.flatnonzero(number[own])
            key = (np.cumsum(number) - 1)[own[some]] * BINS + v[some]
            a = [c.reshape(-1, BINS).cumsum(1) for c in sums.by(key, entry[some], len(here) * BINS)]
            gain = _gain(a, [w[here, None] for w in whole], weight, min_leaf)
            top, row = gain.argmax(1), np.arange(len(here))
            gain = gain[row, top]
            row = row[gain > best[here]]
            won, top = here[row], top[row]
            best[won], which[won], cut[won] = gain[row], slot[won], top
            for s, c in zip(side, a):
                s[won] = c[row, top]
    return which, cut, best, side

"""Deep calibrated forests on binned features: grown in tasks, kept by content, applied to distinct cells.

A fit learns from all rows that it may see. Up to `ROWS` rows go to the tasks one by one; of more, the rows on time and
the late rows of every cell are counted (`cell_trees`), and there are only so many cells. Members are grown side by side,
one task for each (fit, member), their trees level by level. Members of all fits of a job are one Spark job.

Features are whole numbers: 32 bins of every number column, a code for every category. Rows alike in all of them are one
cell, and there are 32^3 * 80 cells, however many rows there are. A leaf is a box of cells, so a forest's mean is laid out
over all cells at once: each leaf adds its value at the corners of its box, and running sums along the bins fill it. To
score any number of rows is then to look up their distinct cells.

Grown forests are appended to one table in the shared folder under the digest of what they learn from and their settings.
A fit whose forest is there, and whole, is not grown again: by another job, or by a driver that goes on after one was lost.
A member that learnt from counts is kept as its mean over all cells, which is smaller than its trees and does not grow.
"""

import hashlib
import json
import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume.functions.formulas import KNOWN_LEVELS
from cargolume.functions.keys import uniform
from cargolume.operators import cell_trees, ordering
from cargolume.operators.cell_trees import BINS
from cargolume.schemas import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from cargolume.session import materialise, shared_folder

ROWS = 10_000      # fits of more rows learn from counts
MASK = 60          # fits that a row's mask has a bit for
BATCH = 400_000    # (tree, row) entries that are grown at once, nodes that are laid out at once
TREES = "digest string, member int, tree int, feature binary, bin binary, left binary, value binary, importance array<double>, curve_x array<double>, curve_y array<double>, slope double, intercept double, grid binary"
COLUMNS = [c for c in TREES.replace(", ", " ").split()[::2]]

# The slots that a tree can split on: bins of numbers, then a yes or no for every known level.
SLOTS = [(c, None) for c in NUMERIC_FEATURES] + [(c, k) for c in CATEGORICAL_FEATURES for k in range(len(KNOWN_LEVELS[c]))]
SIDES = [len(KNOWN_LEVELS[c]) + 1 for c in CATEGORICAL_FEATURES]  # codes of a category; the last is for unknown levels
CELLS = BINS ** len(NUMERIC_FEATURES) * math.prod(SIDES)
SLOT_NAMES = [c if k is None else f"{c}_{KNOWN_LEVELS[c][k]}" for c, k in SLOTS]


# --- cells --------------------------------------------------------------------------------------------

def cell_of(edges: dict[str, list[float]]) -> Column:
    """The row's cell as one number: its bins, then its category codes. An unknown category has the code after the last.

    A row without one of the numbers stops the job. A bin is found by halving, and a number is checked once, not at each
    edge: the same few comparisons are made for every row of every fit.
    """
    code = F.lit(0).cast("long")
    for c in NUMERIC_FEATURES:
        code = code * BINS + _bin_of(F.col(c).cast("double"), edges[c], 0, len(edges[c]))
    for c in CATEGORICAL_FEATURES:
        names, k = KNOWN_LEVELS[c], F.lit(len(KNOWN_LEVELS[c]))
        for i, v in enumerate(names):
            k = F.when(F.col(c) == v, F.lit(i)).otherwise(k)
        code = code * (len(names) + 1) + k
    for c in reversed(NUMERIC_FEATURES):
        x = F.col(c).cast("double")
        code = F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"{c} is missing or not a number")).cast("long")).otherwise(code)
    return code


def with_part(cell: str, other: str, feature: str) -> Column:
    """The cell with the bin or code that another cell has for one feature."""
    sides = {**dict.fromkeys(NUMERIC_FEATURES, BINS), **dict(zip(CATEGORICAL_FEATURES, SIDES))}
    names = list(sides)
    step = math.prod(sides[c] for c in names[names.index(feature) + 1:])

    def part(c):
        return F.pmod(F.floor(F.col(c) / F.lit(step)), F.lit(sides[feature]))

    return (F.col(cell) + (part(other) - part(cell)) * F.lit(step)).cast("long")


def _bin_of(x: Column, edges: list[float], low: int, high: int) -> Column:
    """How many of the rising edges lie below x, when at least `low` and at most `high` do."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(x <= edges[mid], _bin_of(x, edges, low, mid)).otherwise(_bin_of(x, edges, mid + 1, high))


def slots_of(cells: np.ndarray) -> np.ndarray:
    """A row of slot values for every cell."""
    rest, codes = cells.astype(np.int64), {}
    for c in reversed(CATEGORICAL_FEATURES):
        rest, codes[c] = np.divmod(rest, len(KNOWN_LEVELS[c]) + 1)
    for c in reversed(NUMERIC_FEATURES):
        rest, codes[c] = np.divmod(rest, BINS)
    return np.stack([codes[c] if k is None else codes[c] == k for c, k in SLOTS], axis=1).astype(np.uint8)


def edges_of(sample: DataFrame) -> dict[str, list[float]]:
    """Cut values of the number columns: quantiles of the rows that may be learnt from; labels play no part."""
    marks = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    row = sample.agg(*[F.percentile(F.col(c).cast("double"), marks).alias(c) for c in NUMERIC_FEATURES]).first()
    return {c: sorted(set(row[c] or [])) for c in NUMERIC_FEATURES}


def whole_edges(df: DataFrame) -> dict[str, list[float]]:
    """The same of any number of rows, each counted, by passes that keep a bounded table."""
    marks = [i / BINS for i in range(1, BINS)]
    return {c: sorted(set(ordering.quantiles(df, c, marks))) for c in NUMERIC_FEATURES}


# --- what a fit learns from -----------------------------------------------------------------------------

def sizes(df: DataFrame, where: dict[str, Column]) -> tuple[dict[str, int], int]:
    """How many rows each fit may see, and how many any of them."""
    some = reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for w in where.values()])
    row = df.agg(F.count_if(some).alias("any"), *[F.count_if(w).alias(f"n{i}") for i, w in enumerate(where.values())]).first()
    return {n: row[f"n{i}"] for i, n in enumerate(where)}, row["any"]


def counted(df: DataFrame, where: dict[str, Column], edges: dict[str, list[float]]) -> DataFrame:
    """fit, rows, mark (a digest) and the packed cells with their rows on time and late, of every fit, stored.

    Rows meet by cell. Those alike in cell and fits are counted before they are dealt to the fits, in the same place.
    """
    names = list(where)
    fits = [F.coalesce(where[n], F.lit(False)) for n in names]
    masks = {f"m{k}": reduce(lambda a, b: a + b, [F.when(w, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, w in enumerate(fits[k:k + MASK])]) for k in range(0, len(fits), MASK)}
    label = F.when(F.col("label").isin(0.0, 1.0), F.col("label")).otherwise(F.raise_error(F.lit("a label is missing or neither 0 nor 1")).cast("double"))
    rows = df.where(reduce(lambda a, b: a | b, fits)).select(*[m.alias(k) for k, m in masks.items()], cell_of(edges).alias("cell"), label.cast("byte").alias("late"))
    alike = rows.repartition("cell").groupBy(*masks, "cell").agg(F.count("*").alias("n"), F.sum("late").alias("late"))
    seen = F.filter(F.array(*[F.when(F.getbit(f"m{i // MASK * MASK}", F.lit(i % MASK)) == 1, F.lit(i)) for i in range(len(names))]), lambda x: x.isNotNull())
    cells = alike.select(F.explode(seen).alias("fit"), "cell", "n", "late").groupBy("fit", "cell").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))

    def pack(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cell")
        cell, n, late = (frame[c].to_numpy(np.int64) for c in ("cell", "n", "late"))
        return pd.DataFrame({"fit": [names[key[0]]], "rows": [int(n.sum())], "mark": [cell_trees.mark(cell, n - late, late)], "cells": [cell_trees.packed(np.diff(cell, prepend=0))],
                             "on_time": [cell_trees.packed(n - late)], "late": [cell_trees.packed(late)]})

    packed = cells.repartition(4 * len(where), "fit").groupBy("fit").applyInPandas(pack, "fit string, rows long, mark string, cells binary, on_time binary, late binary")
    return materialise(packed, "fit-counts")


def samples(df: DataFrame, where: dict[str, Column], rows: int | None, seed: int, day: str) -> DataFrame:
    """fit, order (a hash) and the feature and label columns of the rows that each fit learns from, stored.

    All rows that `where` lets the fit see; where `rows` is given, about so many of them, drawn by hash, and of every day
    with such a row at least one.
    """
    names = list(where)
    if rows is None:
        kept = [c for c in df.columns if c in FEATURES or c == "label"]
        fits = F.filter(F.array(*[F.when(where[n], F.lit(n)) for n in names]).cast("array<string>"), lambda x: x.isNotNull())
        return materialise(df.select(F.explode(fits).alias("fit"), F.xxhash64("Shipment_ID", F.lit(seed)).alias("order"), *kept), "fit-rows")
    counts = df.agg(*[F.count_if(where[n]).alias(f"n{i}") for i, n in enumerate(names)]).first()
    draw, order = uniform(seed, F.col("Shipment_ID")), F.xxhash64("Shipment_ID", F.lit(seed))
    kept = [c for c in df.columns if c in FEATURES or c == "label"]
    drawn = df.withColumn("_order", order).withColumn("_draw", draw)
    days = drawn.groupBy(F.col(day).alias("_day")).agg(*[F.min(F.when(where[n], F.col("_order"))).alias(f"_m{i}") for i, n in enumerate(names)])
    met = drawn.join(days, F.col(day).eqNullSafe(F.col("_day")))
    chosen = [F.when(where[n] & ((F.col("_draw") < rows / max(counts[f"n{i}"], 1)) | (F.col("_order") == F.col(f"_m{i}"))), F.lit(n)) for i, n in enumerate(names)]
    fits = F.filter(F.array(*chosen), lambda x: x.isNotNull())
    return materialise(met.select(F.explode(fits).alias("fit"), F.col("_order").alias("order"), *kept), "fit-samples")


# --- trees --------------------------------------------------------------------------------------------

def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int, depth: int, min_leaf: int, usable: np.ndarray, rng) -> list[tuple]:
    """`trees` trees as (feature, bin, left, value, importance) arrays; feature -1 is a leaf, the right child follows the left.

    Each tree takes every row a Poisson(1) number of times. A node looks at the root of the number of slots, drawn
    anew, and on at more while none of them splits it. All nodes of a level of all trees are split together.
    """
    n, k = len(y), max(1, math.isqrt(len(usable)))
    out = []
    for first in range(0, trees, step := max(1, BATCH // max(n, 1))):
        out += _grow(x, y, weight, min(step, trees - first), depth, min_leaf, usable, k, rng)
    return out


def _grow(x, y, weight, trees, depth, min_leaf, usable, k, rng):
    times = rng.poisson(1.0, (trees, len(y)))
    tree, row = np.nonzero(times)
    w = times[tree, row] * weight[row]
    w1, slot = w * y[row], tree  # `slot`: place of an entry's node among the level's nodes
    nodes, owner = np.arange(trees), np.arange(trees)  # numbers of the level's nodes, and their trees
    feature, bins, left, value, tree_of, gained = [], [], [], [], [], np.zeros((trees, x.shape[1]))
    made = trees
    for level in range(depth + 1):
        m = len(nodes)
        total, late = np.bincount(slot, w, m), np.bincount(slot, w1, m)
        best = np.full(m, -np.inf)
        which, cut = np.full(m, -1), np.zeros(m, np.int64)
        open_ = (late > 0) & (late < total) & (np.bincount(slot, minlength=m) >= 2 * min_leaf) & (level < depth)
        draw = rng.random((m, len(usable)))
        if open_.any():
            on = open_[slot]
            slot, row, w, w1 = slot[on], row[on], w[on], w1[on]
            here, place = np.flatnonzero(open_), np.cumsum(open_) - 1
            which[here], cut[here] = _splits(x, row, w, w1, place[slot], total[here], late[here], usable[draw[here].argsort(1)], k, min_leaf, best_ := np.full(len(here), -np.inf))
            best[here] = best_
        split = which >= 0
        child = made + 2 * (np.cumsum(split) - 1)
        feature.append(which)
        bins.append(cut)
        left.append(np.where(split, child, 0))
        value.append(late / np.maximum(total, 1e-300))
        tree_of.append(owner)
        if not split.any():
            break
        np.add.at(gained, (owner[split], which[split]), best[split])
        made += 2 * int(split.sum())
        on = split[slot]
        slot, row, w, w1 = slot[on], row[on], w[on], w1[on]
        right = x[row, which[slot]] > cut[slot]
        slot = 2 * (np.cumsum(split) - 1)[slot] + right
        nodes, owner = np.arange(made - 2 * int(split.sum()), made), np.repeat(owner[split], 2)
    feature, bins, left, value, tree_of = map(np.concatenate, (feature, bins, left, value, tree_of))
    out = []
    order = np.argsort(tree_of, kind="stable")
    start = np.searchsorted(tree_of[order], np.arange(trees + 1))
    new = np.empty(made, np.int64)
    new[order] = np.arange(made) - start[tree_of[order]]
    for t in range(trees):
        own = order[start[t]:start[t + 1]]
        share = gained[t] / gained[t].sum() if gained[t].sum() > 0 else gained[t]
        out.append((feature[own].astype(np.int8), bins[own].astype(np.uint8), new[left[own]].astype(np.int32), value[own].astype(np.float32), share))
    return out


def _splits(x, row, w, w1, node, total, late, drawn, k, min_leaf, best) -> tuple[np.ndarray, np.ndarray]:
    """Slot and bin that split every node best (slot -1: none does); the gains go into `best`.

    Sums are taken only over the bins that a node has entries in: between them nothing changes, and nodes far below the
    root have few. They add up in the order of the bins.
    """
    which, cut = np.full(len(total), -1), np.zeros(len(total), np.int64)
    at = row * x.shape[1]
    before = (late**2 + (total - late) ** 2) / total
    for j in range(drawn.shape[1]):
        if j >= k:  # only nodes that nothing has split yet
            todo = which < 0
            here = np.flatnonzero(todo)
            some = np.flatnonzero(todo[node])
            place = (np.cumsum(todo) - 1)[node[some]]
            v, v1, spots = w[some], w1[some], at[some]
        else:
            here, place, v, v1, spots = np.arange(len(total)), node, w, w1, at
        if not len(here):
            break
        slot = drawn[here, j]
        key = place * BINS + x.ravel()[spots + slot[place]]
        met = np.zeros(len(here) * BINS, bool)
        met[key] = True
        key = (np.cumsum(met) - 1)[key]
        owner, bin_ = np.divmod(np.flatnonzero(met), BINS)
        start = np.flatnonzero(np.diff(owner, prepend=-1))
        size = np.diff(start, append=len(owner))
        a, a1 = np.bincount(key, v, len(owner)), np.bincount(key, v1, len(owner))
        an = np.cumsum(np.bincount(key, minlength=len(owner)))
        an -= np.concatenate([[0], an[start[1:] - 1]])[owner]
        open_ = start
        for r in range(1, BINS):
            open_, size = open_[size > r], size[size > r]
            if not len(open_):
                break
            a[open_ + r] += a[open_ + r - 1]
            a1[open_ + r] += a1[open_ + r - 1]
        last = np.append(start[1:], len(owner)) - 1
        b, b1, bn = total[here][owner] - a, late[here][owner] - a1, an[last][owner] - an
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (a1**2 + (a - a1) ** 2) / a + (b1**2 + (b - b1) ** 2) / b - before[here][owner]
        gain = np.where((an >= min_leaf) & (bn >= min_leaf) & (gain > 1e-9), gain, -np.inf)
        top = np.maximum.reduceat(gain, start)
        tops = np.flatnonzero(gain == top[owner])
        spot = bin_[tops[np.diff(owner[tops], prepend=-1) > 0]]  # the first, if several are best
        won = top > best[here]
        best[here[won]], which[here[won]], cut[here[won]] = top[won], slot[won], spot[won]
    return which, cut


def boxes(trees: list[tuple]) -> tuple[np.ndarray, ...]:
    """Every leaf's box: least and largest bin of the number columns, the codes of the categories as bits, and its value."""
    start = np.cumsum([0] + [len(t[0]) for t in trees])
    feature, bins, value = (np.concatenate([t[i] for t in trees]).astype(k) for i, k in ((0, np.int64), (1, np.int64), (3, np.float64)))
    left = np.concatenate([t[2].astype(np.int64) + s for t, s in zip(trees, start)])
    numbers = len(NUMERIC_FEATURES)
    node = start[:-1]
    low, high = np.zeros((len(node), numbers), np.int64), np.full((len(node), numbers), BINS - 1)
    codes = np.tile([(1 << n) - 1 for n in SIDES], (len(node), 1))
    out = []
    while len(node):
        leaf = feature[node] < 0
        out.append((low[leaf], high[leaf], codes[leaf], value[node[leaf]]))
        node, low, high, codes = node[~leaf], low[~leaf], high[~leaf], codes[~leaf]
        f, b = feature[node], bins[node]
        sides = [(low.copy(), high.copy(), codes.copy()) for _ in range(2)]
        for j, (name, level) in enumerate(SLOTS):
            at = np.flatnonzero(f == j)
            if level is None:
                sides[0][1][at, j] = np.minimum(high[at, j], b[at])
                sides[1][0][at, j] = np.maximum(low[at, j], b[at] + 1)
            else:
                c = CATEGORICAL_FEATURES.index(name)
                sides[0][2][at, c] &= ~(1 << level)
                sides[1][2][at, c] &= 1 << level
        node = np.concatenate([left[node], left[node] + 1])
        low, high, codes = (np.concatenate([x, y]) for x, y in zip(*sides))
    return tuple(np.concatenate(x) for x in zip(*out))


def lattice(trees: list[tuple]) -> np.ndarray:
    """Mean leaf value over the trees in every cell, as (category codes, bins of the number columns)."""
    return filled(corners(trees), len(trees))


def corners(trees: list[tuple]) -> np.ndarray:
    """Every leaf's value at the corners of its box; those of several lists of trees add up."""
    low, high, codes, value = boxes(trees)
    some = (codes > 0).all(1) & (low <= high).all(1)
    low, high, codes, value = low[some], high[some], codes[some], value[some]
    inside = np.ones((len(value), 1), bool)
    for c, n in enumerate(SIDES):
        has = (codes[:, c:c + 1] >> np.arange(n)) & 1 > 0
        inside = (inside[:, :, None] & has[:, None, :]).reshape(len(value), -1)
    leaf, combo = np.nonzero(inside)
    side, numbers = BINS + 1, low.shape[1]
    sums = np.zeros(inside.shape[1] * side ** numbers)
    start, held = combo * side ** numbers, value[leaf]
    for corner in range(1 << numbers):
        spot, sign = np.zeros(len(value), np.int64), 1
        for j in range(numbers):
            upper = corner >> j & 1
            spot = spot * side + (high[:, j] + 1 if upper else low[:, j])
            sign = -sign if upper else sign
        sums += sign * np.bincount(start + spot[leaf], held, len(sums))
    return sums


def filled(sums: np.ndarray, trees: int) -> np.ndarray:
    numbers = len(NUMERIC_FEATURES)
    sums = sums.reshape(-1, *[BINS + 1] * numbers)
    for axis in range(1, numbers + 1):
        np.cumsum(sums, axis, out=sums)
    return sums[(slice(None), *[slice(0, BINS)] * numbers)].reshape(len(sums), -1) / max(trees, 1)


def looked_up(grid: np.ndarray, cells: np.ndarray) -> np.ndarray:
    bins, combo = np.divmod(cells.astype(np.int64), len(grid))
    return grid[combo, bins]


# --- calibration curves ---------------------------------------------------------------------------------

def isotonic(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[list, list]:
    """The rising step function nearest to y, as points between which to interpolate; y of n rows each, where n is given."""
    x, inverse = np.unique(score, return_inverse=True)
    n = np.bincount(inverse, n).astype(float)
    blocks = []  # (sum, rows, first point, last point)
    for i, (s, c) in enumerate(zip(np.bincount(inverse, y), n)):
        blocks.append((s, c, i, i))
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, _, last = blocks.pop()
            t, d, first_, _ = blocks.pop()
            blocks.append((s + t, c + d, first_, last))
    px, py = [], []
    for s, c, a, b in blocks:
        for i in {a, b}:
            px.append(float(x[i]))
            py.append(float(s / c))
    order = np.argsort(px, kind="stable")
    return [px[i] for i in order], [py[i] for i in order]


def sigmoid_curve(score: np.ndarray, y: np.ndarray, n: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and intercept of an unpenalised logistic curve, by Newton steps; a tiny ridge keeps separable labels finite.

    With n: y of the n rows of each score.
    """
    design, beta = np.stack([score, np.ones(len(score))], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2), design.T @ (y - n * p) - 1e-6 * beta)
        beta += step * min(1.0, 10 / max(float(np.abs(step).max()), 1e-300))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


# --- Spark jobs -----------------------------------------------------------------------------------------

def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/forests"


def _kept(spark: SparkSession, digests: list[str]) -> DataFrame | None:
    try:
        return spark.read.schema(TREES).parquet(_folder(spark)).where(F.col("digest").isin(digests))
    except AnalysisException:  # none was grown yet
        return None


def _whole(spark: SparkSession, wanted: dict[str, int]) -> set[str]:
    """Digests whose forests are there with all their rows."""
    kept = _kept(spark, list(wanted))
    if kept is None:
        return set()
    found = kept.groupBy("digest").agg(F.count_distinct("member", "tree").alias("n")).collect()
    return {r["digest"] for r in found if r["n"] == wanted[r["digest"]]}


def forests(spark: SparkSession, digests: list[str]) -> DataFrame:
    """The rows of kept forests; a row that a repeated job wrote twice counts once."""
    return _kept(spark, digests).dropDuplicates(["digest", "member", "tree"])


def grown(sample: DataFrame, edges: dict, fits: dict[str, dict], counts: DataFrame | None = None, rows_of: dict[str, str] | None = None) -> dict[str, str]:
    """The digest of every fit's forest; those that are not kept yet are grown in one job.

    `sample`: the rows of fits that learn from single rows, as of `samples`. `counts`: the others, as of `counted`. `fits`
    has for every fit: trees, depth, min_leaf, members (0: one forest on all rows, without a curve), seed, features.
    `rows_of`: the fit whose rows a fit learns from, where that is another.
    """
    spark = sample.sparkSession
    rows = materialise(sample.select("fit", "order", "label", cell_of(edges).alias("cell")), "fit-cells")
    marks = rows.groupBy("fit").agg(F.count("*").alias("n"), F.sum(F.xxhash64("order", "label", "cell").cast("decimal(38,0)")).cast("string").alias("s"))
    marks = {r["fit"]: (r["n"], r["s"]) for r in marks.collect()}
    many = {} if counts is None else {r["fit"]: (r["rows"], r["mark"]) for r in counts.select("fit", "rows", "mark").collect()}
    marks |= many
    source = {name: (rows_of or {}).get(name, name) for name in fits}
    for name in fits:
        if source[name] not in marks:
            raise ValueError(f"no rows to learn from in fit {name}")
    digest = {name: hashlib.sha256(json.dumps([marks[source[name]], edges, fits[name]], sort_keys=True).encode()).hexdigest()[:24] for name in fits}
    chosen = {digest[name]: (name, fits[name]) for name in fits}
    there = _whole(spark, {d: max(s["members"], 1) * (s["trees"] + 1) for d, (_, s) in chosen.items()})
    todo = {name: (d, s) for d, (name, s) in chosen.items() if d not in there}

    def member(key, frame: pd.DataFrame) -> pd.DataFrame:
        return _member(frame, int(key[1]), *todo[key[0]])

    def member_of_counts(key, frame: pd.DataFrame) -> pd.DataFrame:
        return _member_of_counts(frame, int(key[1]), *todo[key[0]])

    for table, grow_one, counted_ in ((rows, member, False), (counts, member_of_counts, True)):
        names = sorted(name for name in todo if (source[name] in many) == counted_)
        if names:
            members = {name: max(todo[name][1]["members"], 1) for name in names}
            asked = spark.createDataFrame([(source[name], name, i) for name in names for i in range(members[name])], "source string, name string, member int")
            dealt = table.join(F.broadcast(asked), F.col("fit") == F.col("source")).drop("source", "fit")
            made = dealt.repartition(8 * sum(members.values()), "name", "member").groupBy("name", "member").applyInPandas(grow_one, TREES)
            made.write.mode("append").parquet(_folder(spark))
    return digest


def _member(frame: pd.DataFrame, i: int, digest: str, s: dict) -> pd.DataFrame:
    """Member i of a fit: its trees learn from the other inner folds, its curves from fold i. Folds deal out each class evenly."""
    frame = frame.sort_values(["label", "order", "cell"], kind="stable")
    y, x = frame["label"].to_numpy(float), slots_of(frame["cell"].to_numpy())
    held = np.zeros(len(y), bool)
    if s["members"]:
        late = y > 0
        place = np.where(late, np.cumsum(late), np.cumsum(~late)) - 1
        held = place % s["members"] == i
    usable = np.array([j for j, (c, _) in enumerate(SLOTS) if c in s["features"]])
    late, n = y[~held].sum(), (~held).sum()
    weight = np.where(y > 0, n / max(2 * late, 1), n / max(2 * (n - late), 1))  # as if classes were balanced
    trees = grow(x[~held], y[~held], weight[~held], s["trees"], s["depth"], s["min_leaf"], usable, np.random.default_rng([s["seed"], i]))
    rows = [(digest, i, t, *(a.tobytes() for a in tree[:4]), tree[4].tolist(), None, None, None, None, None) for t, tree in enumerate(trees)]
    curve = (None, None, None, None)
    if held.any():
        score = looked_up(lattice(trees), frame["cell"].to_numpy()[held])
        curve = (*isotonic(score, y[held]), *sigmoid_curve(score, y[held]))
    return pd.DataFrame([*rows, (digest, i, -1, None, None, None, None, None, *curve, None)], columns=COLUMNS)


def _member_of_counts(frame: pd.DataFrame, i: int, digest: str, s: dict) -> pd.DataFrame:
    """The same from counts: a row for every tree's importance, and one with the curve and the mean of the trees."""
    (fit,) = frame.to_dict("records")
    cells, counts = np.cumsum(cell_trees.unpacked(fit["cells"])), [cell_trees.unpacked(fit[c]) for c in ("on_time", "late")]
    held = [np.zeros_like(c) for c in counts]
    if s["members"]:
        rng = np.random.default_rng([s["seed"], s["members"], len(cells)])  # the same dealing in every member's task
        held = [cell_trees.dealt(c, s["members"], rng)[i] for c in counts]
    seen = [c - h for c, h in zip(counts, held)]
    n, some = sum(int(c.sum()) for c in seen), np.flatnonzero(seen[0] + seen[1])
    weight = tuple(n / max(2 * int(c.sum()), 1) for c in seen)  # as if classes were balanced
    usable = np.array([j for j, (c, _) in enumerate(SLOTS) if c in s["features"]])
    x, shares, waiting, sums = slots_of(cells[some]), [], [], 0.0
    for t in range(s["trees"]):
        tree = cell_trees.grow(x, seen[0][some], seen[1][some], weight, s["depth"], s["min_leaf"], usable, np.random.default_rng([s["seed"], i, t]))
        shares.append(tree[4])
        waiting.append(tree)
        if t == s["trees"] - 1 or sum(len(w[0]) for w in waiting) > BATCH:
            sums, waiting = sums + corners(waiting), []
    grid = filled(sums, s["trees"]).astype(np.float32)
    curve = (None, None, None, None)
    if sum(int(h.sum()) for h in held):
        out = np.flatnonzero(held[0] + held[1])
        score, late, rows = looked_up(grid, cells[out]).astype(float), held[1][out], (held[0] + held[1])[out]
        curve = (*isotonic(score, late, rows), *sigmoid_curve(score, late, rows))
    rows = [(digest, i, t, None, None, None, None, share.tolist(), None, None, None, None, None) for t, share in enumerate(shares)]
    return pd.DataFrame([*rows, (digest, i, -1, None, None, None, None, None, *curve, grid.tobytes())], columns=COLUMNS)


def cell_scores(spark: SparkSession, cells: DataFrame, trees: DataFrame | None = None) -> DataFrame:
    """(digest, cell, plain, isotonic, sigmoid) of distinct cells (digest, cell), stored: the mean over the members.

    A task holds one forest's lattice and its distinct cells, both of a size that the bins fix. `trees`: the forests' rows,
    where they are not the kept ones.
    """
    kind = "digest string, cell long, plain double, isotonic double, sigmoid double"
    cells = materialise(cells.distinct(), "cells")
    digests = [r["digest"] for r in cells.select("digest").distinct().collect()]
    if not digests:
        return spark.createDataFrame([], kind)

    def score(key, frame: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        wanted = frame["cell"].to_numpy()
        sums, members = np.zeros((3, len(wanted))), sorted(forest["member"].unique())
        for i in members:
            own = forest[forest["member"] == i].sort_values("tree")
            curve = own.iloc[0]
            if curve["grid"] is None:
                parts = [tuple(np.frombuffer(r[c], k) for c, k in (("feature", np.int8), ("bin", np.uint8), ("left", np.int32), ("value", np.float32)))
                         for r in own[own["tree"] >= 0][["feature", "bin", "left", "value"]].to_dict("records")]
                s = looked_up(lattice(parts), wanted)
            else:
                s = looked_up(np.frombuffer(curve["grid"], np.float32).reshape(math.prod(SIDES), -1), wanted).astype(float)
            flat = curve["curve_x"] is None or len(curve["curve_x"]) == 0
            sums += [s, s if flat else np.interp(s, curve["curve_x"], curve["curve_y"]),
                     s if flat else 1 / (1 + np.exp(-(curve["slope"] * s + curve["intercept"])))]
        mean = np.clip(sums / max(len(members), 1), 0, 1)
        return pd.DataFrame({"digest": key[0], "cell": frame["cell"], "plain": mean[0], "isotonic": mean[1], "sigmoid": mean[2]})

    trees = forests(spark, digests) if trees is None else trees
    parts = 4 * len(digests)
    both = cells.repartition(parts, "digest").groupBy("digest").cogroup(trees.repartition(parts, "digest").groupBy("digest"))
    return materialise(both.applyInPandas(score, kind), "cell-scores")

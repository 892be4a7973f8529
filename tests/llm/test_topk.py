"""Exact top-k against all inner products."""

import math
import random

import numpy as np
import pytest

from cargolume.llm import topk


def brute(rows, k=10, every=100):
    kept = []
    for d, e in rows:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.append((d, [math.floor(1024 * float(np.float32(x))) for x in e]))
    out = []
    queries = {(d, tuple(v)) for d, v in kept if d is not None and d % every == 0}
    for q, u in queries:
        scores = sorted(((-sum(x * y for x, y in zip(u, v)), d is None, d or 0) for d, v in kept if d != q))[:k]
        out += [(q, r + 1, None if blank else d, -s) for r, (s, blank, d) in enumerate(scores)]
    return sorted(out, key=repr)


def result(spark, rows, **more):
    df = spark.createDataFrame([(d, e, 1, 2, 3) for d, e in rows], "vec_id long, embedding array<float>, block int, score long, rank int")
    return sorted(map(tuple, topk.top_k(df, **more).collect()), key=repr)


def vectors(seed, n, width=12, clusters=6):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.3) for _ in range(width)] for _ in range(clusters)]
    rows = []
    for d in range(-50, n - 50):
        c = rnd.choice(centres)
        rows.append((d, [x + rnd.gauss(0, rnd.choice([0.0, 0.02, 0.1])) for x in c]))
    return rows


@pytest.mark.parametrize("seed,block,slice_", [(1, 8192, 1024), (2, 64, 3)])
def test_against_all_products(spark, monkeypatch, seed, block, slice_):
    """Many ties: a component without noise repeats its centre."""
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SLICE", slice_)
    rows = vectors(seed, 600)
    assert result(spark, rows, every=20) == brute(rows, every=20)


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 5)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (100, [0.5]), (200, []), (300, None), (400, [None, 1.0]), (500, [nan, 1.0]), (600, [inf, 1.0]), (700, [-inf, 0.0]),
            (None, [0.5, 0.25]), (None, [0.1, 0.1]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-0.5, -0.25, 0.9]), (800, [0.5, 0.25]),
            (900, [0.3, 0.3]), (900, [-0.3, 0.3]), (-100, [0.0, 0.0]), (3, [0.0, 0.0])]
    assert result(spark, rows) == brute(rows)


def test_few_and_none(spark):
    assert result(spark, []) == []
    assert result(spark, [(0, [1.0])]) == []
    assert result(spark, [(0, [1.0]), (1, [1.0])]) == [(0, 1, 1, 1024 * 1024)]
    assert result(spark, [(5, [1.0]), (None, [1.0])]) == []


def test_one_common_vector(spark, monkeypatch):
    """A third of all rows are equal: ties go to the smaller id, and nothing is lost."""
    monkeypatch.setattr(topk, "BLOCK", 100)
    rows = [(d, [0.1, 0.2, 0.3] if d % 3 == 0 else [0.01 * (d % 7), -0.2, 0.1]) for d in range(900)]
    assert result(spark, rows) == brute(rows)


def test_stops_early_on_proof():
    """With clusters far apart, a few phases settle the result, and a floor settles it sooner."""
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(40, 32)) * 200
    values = (centres[rnd.integers(0, 40, 4000)] + rnd.normal(size=(4000, 32)) * 5).astype(np.int64)
    made = topk.segments(values)
    block = topk.Block({"ids": list(range(4000)), "vals": values.tobytes(), "width": 32, **{c: made[c].tobytes() for c in ("posts", "dims", "ends", "least", "most")}})
    for own in range(0, 4000, 500):
        rows, scores, read = block.search(own, values[own], 10, None)
        all_scores = values @ values[own]
        want = sorted((-s, d) for d, s in enumerate(all_scores.tolist()) if d != own)[:10]
        assert [(-s, d) for d, s in zip(rows.tolist(), scores.tolist())] == want
        assert read < values.size
        assert block.search(own, values[own], 10, int(scores[-1]))[2] <= read


def test_scores_beyond_a_long_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        result(spark, [(0, [1e9, 1e9]), (1, [1e9, 1e9])])

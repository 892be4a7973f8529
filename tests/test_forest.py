"""Trees, curves, samples and kept forests on their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.operators import forest, model
from cargolume.schemas import FEATURES
from cargolume.session import materialise

SMALL = model.ModelSettings(trees=4, depth=6, members=2, folds=2, seed=11, fit_rows=800)


@pytest.fixture(scope="module")
def prepared(view):
    df = view.withColumn("Full_Date", F.to_date("Shipment_Date")).withColumn("is_delayed", fx.is_delayed())
    return model.prepare(df, SMALL, folds=("random",))


def walk(tree, x):
    """The leaf value of one row, node by node."""
    feature, bins, left, value, _ = tree
    node = 0
    while feature[node] >= 0:
        node = left[node] + (x[feature[node]] > bins[node])
    return value[node]


def walks(x, trees):
    """Mean leaf value of every row."""
    return np.array([np.mean([walk(t, r) for t in trees]) for r in x])


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, forest.BINS, (n, 5)).astype(np.uint8)
    y = (x[:, 1] > 20).astype(float)
    return x, y, rng


def test_trees_find_the_split_and_keep_their_bounds():
    x, y, rng = data()
    trees = forest.grow(x, y, np.ones(len(y)), 30, 30, 2, np.arange(5), rng)
    assert len(trees) == 30
    assert np.mean((walks(x, trees) > 0.5) == y) > 0.98
    assert np.mean([t[4] for t in trees], axis=0).argmax() == 1 and all(t[4].sum() == pytest.approx(1) for t in trees)
    for feature, bins, left, value, _ in trees:
        inner = feature >= 0
        assert ((value >= 0) & (value <= 1)).all() and (left[inner] > np.flatnonzero(inner)).all() and (left[inner] + 1 < len(feature)).all()
        assert sorted([0, *left[inner], *(left[inner] + 1)]) == list(range(len(feature)))  # every node has one parent


@pytest.mark.parametrize("depth", [0, 1, 4, 30])
def test_lattice_is_the_mean_of_single_walks(depth):
    rng = np.random.default_rng(12)
    cells = rng.integers(0, forest.BINS ** 3 * 80, 500)
    cells = np.concatenate([cells, [0, forest.BINS ** 3 * 80 - 1]])
    x, y = forest.slots_of(cells), rng.integers(0, 2, len(cells)).astype(float)
    trees = forest.grow(x, y, np.ones(len(y)), 6, depth, 2, np.arange(13), rng)
    other = rng.integers(0, forest.BINS ** 3 * 80, 300)
    grid = forest.lattice(trees)
    assert grid.shape == (80, forest.BINS ** 3)
    for c in (cells, other):
        assert forest.looked_up(grid, c) == pytest.approx(walks(forest.slots_of(c), trees))


def test_first_split_is_the_best_of_all(monkeypatch):
    """With every slot in play and each row taken once, the root's split has the greatest drop of the Gini index."""
    x, y, _ = data(80, 9)
    y = ((x[:, 2] > 9) ^ (np.arange(80) % 7 == 0)).astype(float)

    class Once:
        def poisson(self, _, shape):
            return np.ones(shape, int)

        def random(self, shape):
            return np.tile(np.arange(shape[1]) / shape[1], (shape[0], 1))

    monkeypatch.setattr(forest.math, "isqrt", lambda n: n)
    (feature, bins, *_), = forest.grow(x, y, np.ones(80), 1, 1, 2, np.arange(5), Once())

    def gini(labels):
        return len(labels) * 2 * labels.mean() * (1 - labels.mean())

    def after(f, b):
        right = x[:, f] > b
        return gini(y[right]) + gini(y[~right]) if min(right.sum(), (~right).sum()) >= 2 else np.inf

    best = min(after(f, b) for f in range(5) for b in range(forest.BINS))
    assert after(feature[0], bins[0]) == pytest.approx(best)


@pytest.mark.parametrize("min_leaf", [1, 5, 60])
def test_leaves_hold_enough_rows(min_leaf):
    x, _, rng = data(200)
    y = rng.integers(0, 2, 200).astype(float)

    class Once:
        poisson = staticmethod(lambda _, shape: np.ones(shape, int))
        random = rng.random

    (tree,) = forest.grow(x, y, np.ones(200), 1, 30, min_leaf, np.arange(5), Once())
    feature, bins, left, _, _ = tree
    at = np.zeros(200, int)
    for _ in range(40):
        inner = feature[at] >= 0
        at = np.where(inner, left[at] + (x[np.arange(200), feature[at]] > bins[at]), at)
    assert np.bincount(at)[np.unique(at)].min() >= min_leaf


def test_isotonic_is_the_nearest_rising_curve():
    rng = np.random.default_rng(5)
    s = np.round(rng.random(60), 1)
    y = (rng.random(60) < s).astype(float)
    px, py = forest.isotonic(s, y)
    fitted = np.interp(s, px, py)
    assert (np.diff(py) >= 0).all() and fitted.sum() == pytest.approx(y.sum())
    points = np.unique(s)  # the minimax formula of isotonic regression
    means = {(a, b): y[(s >= a) & (s <= b)].mean() for a in points for b in points if a <= b}
    for p in points:
        want = max(min(means[a, b] for b in points if b >= p) for a in points if a <= p)
        assert np.interp(p, px, py) == pytest.approx(want)


def test_sigmoid_curve_meets_the_rate():
    rng = np.random.default_rng(6)
    s = rng.random(500)
    y = (rng.random(500) < 1 / (1 + np.exp(-(4 * s - 2)))).astype(float)
    a, b = forest.sigmoid_curve(s, y)
    p = 1 / (1 + np.exp(-(a * s + b)))
    assert p.mean() == pytest.approx(y.mean(), abs=1e-6) and (p * s).mean() == pytest.approx((y * s).mean(), abs=1e-6)
    assert all(map(np.isfinite, forest.sigmoid_curve(s, np.ones(500))))


def test_cells_and_slots(spark):
    edges = {"Distance_km": [10.0, 20.0], "Weight_tons": [], "Vendor_Rating": [3.0]}
    rows = [(10.0, 1.0, 3.0, "Normal", "Low", "Diesel Truck"), (25.0, 1.0, 4.0, "Snow", "High", "Hovercraft")]
    df = spark.createDataFrame(rows, "Distance_km double, Weight_tons double, Vendor_Rating double, Weather_Condition string, Traffic_Density string, Vehicle_Type string")
    x = forest.slots_of(np.array([r[0] for r in df.select(forest.cell_of(edges)).collect()]))
    assert x[:, :3].tolist() == [[0, 0, 0], [2, 0, 1]]
    assert [[n for n, v in zip(forest.SLOT_NAMES[3:], r[3:]) if v] for r in x] == [
        ["Weather_Condition_Normal", "Traffic_Density_Low", "Vehicle_Type_Diesel Truck"], ["Weather_Condition_Snow", "Traffic_Density_High"]]
    with pytest.raises(Exception, match="Distance_km is missing"):
        df.withColumn("Distance_km", F.lit(None).cast("double")).select(forest.cell_of(edges)).collect()


def test_a_cell_takes_few_comparisons(spark):
    """One check a number and a bin by halving; a check and a comparison at every edge took 57 microseconds a row."""
    edges = {c: [i / 7 for i in range(forest.BINS - 1)] for c in ("Distance_km", "Weight_tons", "Vendor_Rating")}
    text = str(forest.cell_of(edges)).lower()
    assert text.count("missing or not a number") == 3
    x = [e + d for e in edges["Distance_km"] for d in (-1e-3, 0.0, 1e-3)]
    found = spark.createDataFrame([(v,) for v in x], "x double").select("x", forest._bin_of(F.col("x"), edges["Distance_km"], 0, forest.BINS - 1).alias("b")).collect()
    assert all(r["b"] == sum(r["x"] > e for e in edges["Distance_km"]) for r in found)


def test_splits_are_those_of_full_histograms():
    """Sums over the bins that a node has entries in find what a table of all bins finds."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, forest.BINS, (300, 4)).astype(np.uint8)
    x[:, 3] = x[:, 3] > 15
    row, node = rng.integers(0, 300, 700), np.sort(np.concatenate([np.arange(60), rng.integers(0, 60, 640)]))
    w = rng.integers(1, 4, 700).astype(float)
    w1 = w * rng.integers(0, 2, 700)
    total, late = np.bincount(node, w), np.bincount(node, w1)
    drawn = rng.random((60, 4)).argsort(1)
    best = np.full(60, -np.inf)
    which, cut = forest._splits(x, row, w, w1, node, total, late, drawn, 2, 2, best)
    for i in range(60):
        gains = []
        for j in drawn[i]:
            for b in range(forest.BINS):
                one = (node == i) & (x[row, j] <= b)
                two = (node == i) & (x[row, j] > b)
                if min(one.sum(), two.sum()) >= 2:
                    value = [(w1[s].sum() ** 2 + (w[s].sum() - w1[s].sum()) ** 2) / w[s].sum() for s in (one, two)]
                    gain = sum(value) - (late[i] ** 2 + (total[i] - late[i]) ** 2) / total[i]
                    if gain > 1e-9:
                        gains.append((gain, j, b))
            if gains and j in drawn[i][1:]:
                break
        if gains:
            top = max(g for g, _, _ in gains)
            assert (best[i], which[i], cut[i]) == next((pytest.approx(g), j, b) for g, j, b in gains if g >= top - 1e-12)
        else:
            assert which[i] == -1


def test_sample_is_bounded_and_holds_every_day(prepared):
    kept = forest.samples(prepared, {"all": F.lit(True), "some": F.col("random_fold") == 0}, 500, 1, "Full_Date")
    days = prepared.select("Full_Date").distinct().count()
    for name, rows in (("all", prepared), ("some", prepared.where("random_fold = 0"))):
        n = kept.where(F.col("fit") == name).count()
        assert rows.select("Full_Date").distinct().count() <= n <= 500 + days + 100
    again = forest.samples(prepared.repartition(7), {"all": F.lit(True)}, 500, 1, "Full_Date")
    assert sorted(r[0] for r in again.select("order").collect()) == sorted(r[0] for r in kept.where("fit = 'all'").select("order").collect())


def test_rare_class_is_in_every_member():
    """12 late rows in 600 over 5 members: each curve sees its share of them."""
    import pandas as pd

    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"label": [1.0] * 12 + [0.0] * 588, "order": rng.permutation(600), "cell": rng.integers(0, 10**6, 600)})
    s = {**SMALL.grown_as(), "members": 5, "trees": 2}
    for i in range(5):
        made = forest._member(frame, i, "d", s)
        assert len(made) == 3 and made.iloc[-1]["curve_y"] and max(made.iloc[-1]["curve_y"]) > 0


def test_kept_forests_are_not_grown_again(spark, prepared, monkeypatch):
    first = model.fit_model(prepared, SMALL)
    n = first.trees().count()
    assert n == 2 * 5
    grown = []
    plain = forest.grow
    monkeypatch.setattr(forest, "grow", lambda *a: grown.append(1) or plain(*a))
    monkeypatch.setattr(forest, "_member", None)  # any task that grows would fail
    again = model.fit_model(prepared.repartition(5), SMALL)
    sigmoid = model.fit_model(prepared, model.ModelSettings(**{**SMALL.__dict__, "method": "sigmoid"}))
    assert again.digest == first.digest == sigmoid.digest and again.trees().count() == n


def test_half_a_forest_is_grown_again(spark, prepared):
    chosen = model.ModelSettings(**{**SMALL.__dict__, "seed": 77})
    digest = model.fit_model(prepared, chosen).digest
    assert forest._whole(spark, {digest: 2 * 5}) == {digest} and forest._whole(spark, {digest: 2 * 5 + 1}) == set()


def test_scores_of_cells_are_those_of_rows(spark, prepared):
    """Each row by hand: its cell, the members' trees, their curves."""
    fitted = model.fit_model(prepared, SMALL)
    rows = prepared.orderBy("Shipment_ID").limit(40)
    got = {r["Shipment_ID"]: r["probability"] for r in fitted.transform(rows).collect()}
    trees = fitted.trees().collect()
    for r in rows.select("Shipment_ID", forest.cell_of(fitted.edges).alias("cell")).collect():
        x, p = forest.slots_of(np.array([r["cell"]]))[0], []
        for i in range(2):
            own = [t for t in trees if t["member"] == i]
            parts = [tuple(np.frombuffer(t[c], k) for c, k in (("feature", np.int8), ("bin", np.uint8), ("left", np.int32), ("value", np.float32))) for t in own if t["tree"] >= 0]
            curve = next(t for t in own if t["tree"] < 0)
            p.append(np.interp(np.mean([walk((*t, None), x) for t in parts]), curve["curve_x"], curve["curve_y"]))
        assert got[r["Shipment_ID"]] == pytest.approx(np.mean(p))


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1000])
def test_computed_permutation(spark, n):
    rows = materialise(spark.range(n).withColumnRenamed("id", "_place"), "places")
    got = model.permuted(rows, 3, 5).collect()
    for repeat in range(3):
        own = sorted((r["place"], r["donor"]) for r in got if r["repeat"] == repeat)
        assert [p for p, _ in own] == list(range(n)) and sorted(d for _, d in own) == list(range(n))
    if n == 1000:
        for repeat in range(3):
            moved = [d for p, d in sorted((r["place"], r["donor"]) for r in got if r["repeat"] == repeat)]
            assert abs(np.corrcoef(range(n), moved)[0, 1]) < 0.12 and sum(p == d for p, d in enumerate(moved)) < 12


def test_features_left_out_are_not_split_on(prepared):
    fewer = model.ModelSettings(**{**SMALL.__dict__, "features": tuple(f for f in FEATURES if f != "Vendor_Rating")})
    fitted = model.fit_model(prepared, fewer)
    used = set()
    for r in fitted.trees().where("tree >= 0").collect():
        used |= set(np.frombuffer(r["feature"], np.int8).tolist())
    assert forest.SLOT_NAMES.index("Vendor_Rating") not in used
    assert fitted.transform(prepared.drop("Vendor_Rating")).where("probability IS NULL").count() == 0

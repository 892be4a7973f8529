"""Fits learn from all rows that they may see: from counts per cell, where these are many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.operators import cell_trees, forest, metrics, model
from cargolume.session import fresh_path

TINY = model.ModelSettings(trees=8, depth=6, members=2, folds=2, seed=11)


@pytest.fixture(scope="module")
def prepared(view):
    df = view.withColumn("Full_Date", F.to_date("Shipment_Date")).withColumn("is_delayed", fx.is_delayed())
    return model.prepare(df, TINY, folds=("random",))


def shipments(spark, n):
    """n shipments of a few days, late where the rating is low."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("S"), i).alias("Shipment_ID"), F.date_add(F.lit("2026-01-01").cast("date"), (i % 5).cast("int")).alias("Full_Date"), (100.0 + i % 900).alias("Distance_km"),
        (1.0 + i % 20).alias("Weight_tons"), (1.0 + (i % 41) / 10.0).alias("Vendor_Rating"), F.lit("Normal").alias("Weather_Condition"),
        F.lit("Low").alias("Traffic_Density"), F.lit("Diesel Truck").alias("Vehicle_Type"), (i % 41 < 10).cast("double").alias("label"), (i % 41 < 10).cast("int").alias("is_delayed"))


def test_every_row_is_learnt_from(spark, monkeypatch):
    """12,500 rows, a repeated row among them; a sample held about 10,000."""
    df = shipments(spark, 12_500)
    df = df.unionByName(df.where("Shipment_ID = 'S7'"))
    seen = {}

    def grown(sample, edges, fits, counts=None, rows_of=None):
        rows = {r["fit"]: r["n"] for r in sample.groupBy("fit").agg(F.count("*").alias("n")).collect()}
        seen.update(rows | ({r["fit"]: r["rows"] for r in counts.collect()} if counts is not None else {}))
        return {n: "d" for n in fits}

    monkeypatch.setattr(forest, "grown", grown)
    s = model.ModelSettings()
    model.fit_many(df, {"all": (F.lit(True), s), "most": (F.dayofmonth("Full_Date") > 1, s), "few": (F.dayofmonth("Full_Date") == 2, s)})
    assert seen == {"all": 12_501, "most": 10_001, "few": 2_500}


def test_counts_hold_every_row_of_a_cell_and_label(spark):
    df = shipments(spark, 3000)
    edges = forest.whole_edges(df)
    assert edges == {c: pytest.approx(v) for c, v in forest.edges_of(df).items()}
    got = {r["fit"]: r for r in forest.counted(df, {"all": F.lit(True), "some": F.col("Weight_tons") > 5}, edges).collect()}
    for name, rows in (("all", df), ("some", df.where("Weight_tons > 5"))):
        want = {r["cell"]: (r["n"] - int(r["late"]), int(r["late"])) for r in rows.groupBy(forest.cell_of(edges).alias("cell")).agg(F.count("*").alias("n"), F.sum("label").alias("late")).collect()}
        cells, on_time, late = np.cumsum(cell_trees.unpacked(got[name]["cells"])), *(cell_trees.unpacked(got[name][c]) for c in ("on_time", "late"))
        assert dict(zip(cells.tolist(), zip(on_time.tolist(), late.tolist()))) == want and got[name]["rows"] == rows.count()
    with pytest.raises(Exception, match="label is missing"):
        forest.counted(df.withColumn("label", F.lit(None).cast("double")), {"all": F.lit(True)}, edges)


def test_draws_are_those_of_single_rows():
    rng, n = np.random.default_rng(1), 40_000
    total, rows = cell_trees.taken(np.full(n, 3), rng)
    single = rng.poisson(1.0, (n, 3))
    for a, b in ((total, single.sum(1)), (rows, (single > 0).sum(1)), (total * rows, single.sum(1) * (single > 0).sum(1))):
        assert a.mean() == pytest.approx(b.mean(), rel=0.02) and a.std() == pytest.approx(b.std(), rel=0.03)
    counts = rng.integers(0, 9, 1000)
    folds = cell_trees.dealt(counts, 4, rng)
    assert (sum(folds) == counts).all() and max(f.sum() for f in folds) - min(f.sum() for f in folds) <= 1 and min(f.min() for f in folds) >= 0
    # in a cell of 2 rows both lie in the same fold a quarter of the time: single rows are dealt, not shares of cells
    both = sum((f == 2).sum() for f in cell_trees.dealt(np.full(4000, 2), 4, rng)) / 4000
    assert both == pytest.approx(0.25, abs=0.03)


class Once:
    """Takes every row once, and looks at the slots in order."""

    def __init__(self):
        self.first = True

    def binomial(self, n, p):
        return n if p > 0.6 else np.zeros_like(n)

    def random(self, shape):
        return np.tile(np.arange(shape[1]) / shape[1], (shape[0], 1))


@pytest.mark.parametrize("wide", [False, True])
def test_first_split_is_the_best_of_all(monkeypatch, wide):
    rng = np.random.default_rng(9)
    if wide:  # counts that do not share a number
        monkeypatch.setattr(cell_trees._Sums, "pack", lambda self: None)
    x = rng.integers(0, 32, (90, 5)).astype(np.uint8)
    x[:, 3:] = x[:, 3:] > 15
    counts = rng.integers(0, 6, (2, 90))
    monkeypatch.setattr(cell_trees.math, "isqrt", lambda n: n)
    feature, bins, left, value, share = cell_trees.grow(x, counts[0], counts[1], (1.0, 2.0), 1, 2, np.arange(5), Once())

    def gini(at):
        a, b = counts[0][at].sum(), 2.0 * counts[1][at].sum()
        return 2 * a * b / (a + b)

    def after(f, b):
        right = x[:, f] > b
        return gini(right) + gini(~right) if min(counts[:, right].sum(), counts[:, ~right].sum()) >= 2 else np.inf

    assert after(feature[0], bins[0]) == pytest.approx(min(after(f, b) for f in range(5) for b in range(32)))
    for node, at in ((0, x[:, 0] >= 0), (1, x[:, feature[0]] <= bins[0]), (2, x[:, feature[0]] > bins[0])):
        assert value[node] == pytest.approx(2 * counts[1][at].sum() / (counts[0][at].sum() + 2 * counts[1][at].sum()))
    assert share.sum() == pytest.approx(1) and left.tolist() == [1, 0, 0]


def test_trees_of_counts_are_those_of_rows():
    """Forests from rows and from counts differ no more than two forests from rows."""
    rng = np.random.default_rng(4)
    cells = rng.choice(rng.integers(0, forest.BINS**3 * 80, 300), 3000)
    y = (rng.random(3000) < 0.1 + 0.6 * (cells % 7 > 3)).astype(float)
    unique, place = np.unique(cells, return_inverse=True)
    late = np.bincount(place, y).astype(int)
    x = forest.slots_of(unique)
    rows = [forest.grow(forest.slots_of(cells), y, np.ones(3000), 60, 30, 2, np.arange(13), np.random.default_rng(s)) for s in (1, 2)]
    counts = [cell_trees.grow(x, np.bincount(place) - late, late, (1.0, 1.0), 30, 2, np.arange(13), np.random.default_rng([3, t])) for t in range(60)]
    a, b, c = (forest.looked_up(forest.lattice(t), unique) for t in (*rows, counts))
    assert np.abs(c - a).mean() < 1.2 * np.abs(b - a).mean() + 0.002
    size = [np.mean([len(t[0]) for t in trees]) for trees in (rows[0], counts)]
    assert size[0] == pytest.approx(size[1], rel=0.05)
    importance = [np.mean([t[4] for t in trees], 0) for trees in (rows[0], counts)]
    assert np.abs(importance[0] - importance[1]).max() < 0.05


def test_a_model_of_counts(spark, prepared, monkeypatch):
    """Grown once, kept as its mean over the cells, saved and read back; no worse than one of single rows."""
    single = metrics.metric_bundle(model.fit_model(prepared, TINY).transform(prepared), "probability").first()
    monkeypatch.setattr(forest, "ROWS", 100)
    fitted = model.fit_model(prepared, TINY)
    trees = fitted.trees()
    assert trees.count() == 2 * 9 and trees.where("grid IS NOT NULL").count() == 2 and trees.where("feature IS NOT NULL").count() == 0
    found = metrics.metric_bundle(fitted.transform(prepared), "probability").first()
    assert found["roc_auc"] > single["roc_auc"] - 0.02 and found["ece"] < 0.05 and found["brier"] < found["baseline_brier"]
    assert model.impurity_importance(spark, fitted).agg(F.sum("importance")).first()[0] == pytest.approx(1.0, abs=1e-3)
    again = model.fit_model(prepared.repartition(5), TINY)
    assert again.digest == fitted.digest and again.trees().count() == 2 * 9
    path = fresh_path(spark, "model")
    fitted.save(path)
    assert model.verify_saved(spark, path, fitted, prepared.limit(50)).first()["largest_difference"] < 1e-9
    for method in ("sigmoid", "none"):
        out = model.fit_model(prepared, model.ModelSettings(**{**TINY.__dict__, "method": method})).transform(prepared)
        assert out.where("probability NOT BETWEEN 0 AND 1 OR probability IS NULL").count() == 0

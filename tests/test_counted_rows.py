"""Comparisons of models fan out from counts of like rows, and stored copies of the training table do not pile up."""

import os

import pytest
from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.operators import forest, metrics, model
from cargolume.session import shared_folder

TINY = model.ModelSettings(trees=4, depth=4, members=2, folds=2, seed=5)


@pytest.fixture(scope="module")
def dated(view):
    return view.withColumn("Full_Date", F.to_date("Shipment_Date")).withColumn("is_delayed", fx.is_delayed())


@pytest.fixture(scope="module")
def prepared(dated):
    return model.prepare(dated, TINY)


def training_tables(spark):
    folder = shared_folder(spark)
    return {d for d in os.listdir(folder) if d.startswith("training-")}


def test_one_copy_of_the_training_table_stays(spark, dated):
    before = training_tables(spark)
    kept = model.prepare(dated, TINY)
    assert len(training_tables(spark) - before) == 1
    assert kept.columns[-3:] == ["time_fold", "vendor_fold", "random_fold"] and kept.count() == dated.count()
    assert kept.groupBy("Vendor_ID").agg(F.count_distinct("vendor_fold").alias("n")).where("n <> 1").count() == 0
    sizes = [r["count"] for r in kept.groupBy("random_fold", "is_delayed").count().orderBy("is_delayed", "random_fold").collect()]
    assert abs(sizes[0] - sizes[1]) <= 1 and abs(sizes[2] - sizes[3]) <= 1


def test_measures_of_counts_are_those_of_rows(prepared):
    twice = prepared.unionByName(prepared.where("random_fold = 0"))  # rows that come twice count twice
    fits = model.fold_fits("random_fold", TINY)
    models = model.fit_many(twice, fits)
    rows = model.apply_fits(twice, model.named("random_fold"), models)
    counts = model._scored(model.counted_rows(twice, models, "random_fold"), model.named("random_fold"), models)
    assert counts.agg(F.sum("_rows")).first()[0] == twice.count() > counts.count()
    for measure, by in ((metrics.metric_bundle, ["random_fold"]), (metrics.calibration_error, []), (metrics.roc_auc, ["random_fold"])):
        want, got = (sorted(list(r) for r in measure(df, "probability", by=by, **more).collect()) for df, more in ((rows, {}), (counts, {"weight": "_rows"})))
        assert got == [pytest.approx(w, abs=1e-12) for w in want]


def test_comparisons_do_not_multiply_rows(prepared, monkeypatch):
    """What is scored is counted first: fewer rows than the table has, times the models compared."""
    scored = []
    plain = model._scored
    monkeypatch.setattr(model, "_scored", lambda df, *a, **k: scored.append(df) or plain(df, *a, **k))
    few = prepared.withColumns({"Distance_km": F.lit(1.0), "Weight_tons": F.lit(1.0), "Weather_Condition": F.lit("Rain")})
    model.feature_ablation(few, TINY, drop=("Distance_km",)).collect()
    assert "_rows" in scored[0].columns and scored[0].count() < few.count()


def test_fits_on_the_same_rows_are_counted_once(prepared, monkeypatch):
    monkeypatch.setattr(forest, "ROWS", 100)
    asked = []
    plain = forest.counted
    monkeypatch.setattr(forest, "counted", lambda df, where, edges: asked.append(sorted(where)) or plain(df, where, edges))
    fewer = model.ModelSettings(**{**TINY.__dict__, "features": TINY.features[:3]})
    fits = model.fold_fits("random_fold", TINY, "a-") | model.fold_fits("random_fold", fewer, "b-")
    models = model.fit_many(prepared, fits)
    assert asked == [["a-0", "a-1"]] and len({m.digest for m in models.values()}) == 4

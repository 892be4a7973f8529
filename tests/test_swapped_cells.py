"""Permutation importance on cells: the same drops as with rows that take their donors' values."""

import pytest
from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.operators import forest, metrics, model, ordering
from cargolume.schemas import FEATURES
from cargolume.session import materialise

TINY = model.ModelSettings(trees=4, depth=5, members=2, folds=2, seed=5)


@pytest.fixture(scope="module")
def prepared(view):
    df = view.withColumn("Full_Date", F.to_date("Shipment_Date")).withColumn("is_delayed", fx.is_delayed())
    return model.prepare(df, TINY, folds=())


def test_a_cell_takes_one_part_of_another(prepared):
    edges = forest.edges_of(prepared)
    one = prepared.orderBy("Shipment_ID").limit(30).select(*FEATURES, F.monotonically_increasing_id().alias("i"))
    other = one.select((29 - F.col("i")).alias("i"), *[F.col(c).alias(f"o_{c}") for c in FEATURES])
    both = one.join(other, "i")
    for feature in FEATURES:
        mixed = both.withColumn("_a", forest.cell_of(edges)).drop(feature).withColumnRenamed(f"o_{feature}", feature).withColumn("want", forest.cell_of(edges))
        donor = both.select("i", *[F.col(f"o_{c}").alias(c) for c in FEATURES]).select("i", forest.cell_of(edges).alias("_b"))
        assert mixed.join(donor, "i").where(forest.with_part("_a", "_b", feature) != F.col("want")).count() == 0


def test_drops_are_those_of_swapped_rows(prepared, monkeypatch):
    fitted, test = model.fit_model(prepared, TINY), prepared.where("Full_Date > '1998-06-01'")
    scored = []
    plain = model._scored
    monkeypatch.setattr(model, "_scored", lambda df, *a, **k: scored.append(df) or plain(df, *a, **k))
    got = {r["feature"]: (r["auc_drop"], r["std"]) for r in model.permutation_importance(fitted, test, repeats=2, seed=3).collect()}
    assert set(scored[0].columns) == {"repeat", "feature", "is_delayed", "_cell"}
    monkeypatch.undo()
    rows = materialise(ordering.positions(test.select("Shipment_ID", "is_delayed", *FEATURES).withColumn("_all", F.lit(0)), "_all", "Shipment_ID", "_place", overall=False), "rows")
    whole = metrics.roc_auc(fitted.transform(rows), "probability").first()[0]
    donors = rows.select(F.col("_place").alias("donor"), *[F.col(c).alias(f"d_{c}") for c in FEATURES])
    paired = materialise(model.permuted(rows, 2, 3).join(rows, F.col("place") == F.col("_place")).join(donors, "donor"), "paired")
    for feature in ("Vendor_Rating", "Weather_Condition"):
        swapped = paired.withColumn(feature, F.col(f"d_{feature}"))
        drops = [whole - r["roc_auc"] for r in metrics.roc_auc(fitted.transform(swapped), "probability", by=["repeat"]).collect()]
        mean = sum(drops) / 2
        assert got[feature] == (pytest.approx(mean, abs=1e-12), pytest.approx(abs(drops[0] - mean), abs=1e-12))

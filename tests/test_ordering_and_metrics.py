import hashlib
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume.errors import IntegrityError
from cargolume.operators import kpis, metrics, ordering, splits


def sha(x):
    return hashlib.sha1(x.encode()).hexdigest()


def in_order(df):
    return sorted(df.collect(), key=lambda r: (r["Full_Date"], sha(r["Shipment_ID"])))


@pytest.mark.parametrize("slice_rows", [1, 7, 10_000])
def test_positions_are_exact_on_a_hot_day(hot_day, slice_rows):
    got = {r["Shipment_ID"]: r["position"] for r in ordering.positions(hot_day, "Full_Date", slice_rows=slice_rows).collect()}
    assert got == {r["Shipment_ID"]: i for i, r in enumerate(in_order(hot_day))}


def test_a_class_is_not_dealt_to_one_task(spark):
    """Counts go to the rows; before, both were dealt by class, and 0.8 of all rows could meet in one task."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(50).select(F.col("id").cast("string").alias("Shipment_ID"), (F.col("id") % 5 == 0).cast("int").alias("late"))
        plan = ordering.positions(df, "late")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("BroadcastHashJoin") == 2  # of the numbered rows, and of those that slices are counted on
    assert ordering.SLICE_ROWS <= 100_000


def test_positions_with_null_group(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", None)], "Shipment_ID string, g int")
    got = {r["Shipment_ID"]: r["position"] for r in ordering.positions(df, "g").collect()}
    assert sorted(got.values()) == [0, 1, 2] and got["b"] == 2


def test_hot_day_is_split_over_tasks(hot_day):
    sliced = hot_day.where("Full_Date = DATE '2026-01-05'").select(F.substring(ordering.spread_key(), 1, 1).alias("s"))
    assert sliced.distinct().count() == 16


@pytest.mark.parametrize("pick_rows", [5, 50_000])
def test_cuts_equal_positions(hot_day, pick_rows):
    rows = in_order(hot_day)
    for at in (0, 1, 437, 800, 999):
        cut, = ordering.chronological_cuts(hot_day, [at], pick_rows=pick_rows)
        assert cut == (rows[at]["Full_Date"], sha(rows[at]["Shipment_ID"]))
        assert hot_day.where(ordering.from_cut(cut)).count() == 1000 - at
    assert ordering.chronological_cuts(hot_day, [1000]) == [None]


def test_splits_do_not_depend_on_partitions(hot_day):
    a = splits.expanding_folds(hot_day, 4).select("Shipment_ID", "fold")
    b = splits.expanding_folds(hot_day.repartition(1), 4).select("Shipment_ID", "fold")
    assert a.exceptAll(b).count() == 0
    assert {r["fold"]: r["count"] for r in a.groupBy("fold").count().collect()} == {0: 200, 1: 200, 2: 200, 3: 200, 4: 200}


def test_holdout_allows_the_boundary_day_on_both_sides(hot_day):
    split = splits.require_chronology(splits.chronological_holdout(hot_day))
    assert split.where("split = 'test'").count() == 200
    wrong = hot_day.withColumn("split", F.when(F.col("Full_Date") < date(2026, 1, 3), "test").otherwise("train"))
    with pytest.raises(IntegrityError):
        splits.require_chronology(wrong)


def test_grouped_folds_keep_groups_whole(view):
    df = view.withColumn("is_delayed", (F.col("Actual_Delay_Days") > 0).cast("int"))
    folds = splits.grouped_folds(df, 3).select("Vendor_ID", "fold")
    assert folds.count() == df.count()
    assert folds.distinct().groupBy("Vendor_ID").count().agg(F.max("count")).first()[0] == 1
    assert folds.where("fold IS NULL OR fold NOT BETWEEN 0 AND 2").count() == 0


def test_stratified_folds_are_even(hot_day):
    rows = splits.stratified_folds(hot_day, 5, slice_rows=9).groupBy("is_delayed", "fold").count().collect()
    assert {r["count"] for r in rows} == {100} and len(rows) == 10


@pytest.mark.parametrize("bins,pick", [(4, 3), (2048, 50_000)])
def test_kth_values_equal_a_sort(spark, bins, pick):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=400), np.full(300, 0.25), [1e6, -1e6]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    ranks = [0, 1, 250, 400, 500, len(x) - 1]
    s = np.sort(x)
    got = ordering.kth_values(df, "x", ranks, pick_rows=pick, bins=bins)
    assert got == [(s[k], int((x < s[k]).sum())) for k in ranks]


def test_quantiles_interpolate(spark):
    x = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    assert ordering.quantiles(df, "x", [0.25, 0.5, 0.75]) == pytest.approx(list(np.quantile(x, [0.25, 0.5, 0.75])))


def scored(spark, p, y):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, is_delayed int")


def brute_auc(p, y):
    pos, neg = p[y == 1], p[y == 0]
    return float(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))


@pytest.mark.parametrize("range_rows", [3, 10, 10**6])
def test_auc_with_ties(spark, range_rows):
    rng = np.random.default_rng(3)
    p, y = np.round(rng.random(300), 2), rng.integers(0, 2, 300)
    df = scored(spark, p, y).withColumn("g", F.lit("a"))
    assert metrics.roc_auc(df, "p", range_rows=range_rows).first()[0] == pytest.approx(brute_auc(p, y))
    assert metrics.roc_auc(df, "p", by=["g"], range_rows=range_rows).first()["roc_auc"] == pytest.approx(brute_auc(p, y))


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scored(spark, [0.1, 0.2], [1, 1]), "p").first()[0] is None


def test_calibration_error_by_hand(spark):
    row = metrics.metric_bundle(scored(spark, [0.05, 0.05, 0.95, 0.95], [0, 1, 1, 1]), "p").first()
    assert row["ece"] == pytest.approx(0.5 * 0.45 + 0.5 * 0.05)
    assert row["brier"] == pytest.approx((0.05**2 + 0.95**2 + 2 * 0.05**2) / 4)
    assert row["baseline_brier"] == pytest.approx(0.75 * 0.25)


def test_bin_edges(spark):
    df = scored(spark, [0.3, 0.1, 1.0, 0.0], [0, 0, 0, 0])
    low = {r[0]: r[1] for r in df.select("p", metrics._bin(F.col("p"), 10)).collect()}
    assert low == {0.3: 2, 0.1: 1, 1.0: 9, 0.0: 0}
    high = {r[0]: r[1] for r in df.select("p", metrics._bin(F.col("p"), 10, True)).collect()}
    assert high[0.1] == 0 and high[1.0] == 9 and high[0.0] == 0


def test_alert_cost_by_hand(spark):
    df = scored(spark, [0.9, 0.6, 0.2, 0.1], [1, 0, 1, 0])
    row = metrics.alert_cost(df, "p", 0.5, 4.0).first()
    assert (row["tp"], row["fp"], row["fn"], row["alert_rate"], row["cost"]) == (1, 1, 1, 0.5, 5.0)
    curve = metrics.alert_cost_curve(df, "p", [0.0, 0.2, 2.0], [1.0]).orderBy("threshold").collect()
    assert [(r["tp"], r["fp"], r["fn"]) for r in curve] == [(2, 2, 0), (2, 1, 0), (0, 0, 2)]


def test_tier_table_keeps_empty_tiers(spark):
    df = spark.createDataFrame([("a", 0.1, "Low Risk", 0, 0)], "Shipment_ID string, Delay_Risk_Probability double, Risk_Level string, is_delayed int, Actual_Delay_Days int")
    rows = metrics.calibration_by_tier(df).collect()
    assert [r["Risk_Level"] for r in rows] == ["High Risk", "Medium Risk", "Low Risk"] and rows[0]["shipments"] is None


def test_offset_hits_the_target(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    c = kpis.solve_offset(df, "x", 0.3)
    assert np.mean(1 / (1 + np.exp(-(x + c)))) == pytest.approx(0.3, abs=1e-8)


def test_corridor_pooling_by_hand(tiny_raw):
    got = {r["window_days"]: r["legs_eliminated"] for r in kpis.corridor_pooling(tiny_raw, [1, 30]).collect()}
    assert got[1] == 2 and got[30] == 4


def test_empty_report_is_blank_not_an_error(spark, tiny_raw):
    df = tiny_raw.limit(0).withColumn("Risk_Level", F.lit("x")).withColumn("Delay_Risk_Probability", F.lit(0.1))
    row = kpis.report(df).first()
    assert row["total_shipments"] == 0 and row["high_risk_rate"] is None

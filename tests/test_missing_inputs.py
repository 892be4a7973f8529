"""Missing or unreadable inputs stop a job or are set apart; none is lost or given a number."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError, IntegrityError
from cargolume.functions import formulas as fx
from cargolume.operators import allocation, calibrate, metrics, ordering, panels, star
from cargolume.plans import jobs
from cargolume.session import fresh_path
from cargolume.sources import readers, writers


def scored(spark, odd):
    return spark.createDataFrame([(0.1, 0), (0.9, 1), (0.5, 1), (0.5, 0), (odd, 1)], "p double, is_delayed int")


@pytest.mark.parametrize("odd", [None, float("nan")])
def test_no_score_no_ranking(spark, odd):
    with pytest.raises(PySparkException, match="missing or not a number"):
        metrics.roc_auc(scored(spark, odd), "p").collect()


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_no_quantile_of_a_non_number(spark, odd):
    with pytest.raises(ValueError, match="NaN or infinite"):
        ordering.quantiles(scored(spark, odd), "p", [0.5])


def test_auc_does_not_depend_on_ranges_or_partitions(spark):
    rows = [((k * 37 % 101) / 100.0, int(k * 53 % 7 < 3), None if k % 3 else "a") for k in range(2000)]
    df = spark.createDataFrame(rows, "p double, is_delayed int, g string")
    got = {metrics.roc_auc(df.repartition(n), "p", range_rows=r).first()[0] for n, r in ((1, 10), (7, 3), (3, 10**6))}
    assert len(got) == 1
    assert len({tuple(sorted(metrics.roc_auc(df, "p", by=["g"], range_rows=r).collect(), key=repr)) for r in (3, 10**6)}) == 1


def test_a_missing_probability_stays_missing(spark):
    df = scored(spark, None).union(scored(spark, float("nan")))
    assert df.where(fx.logit("p").isNull()).count() == 2


def panel(spark, **change):
    rows = [(f"S{i}", 100.0 + i, 5.0, P.VEHICLES[i % 3], "Normal", "Low", 0.2 + i / 100, i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "Shipment_ID string, Distance_km double, Weight_tons double, Vehicle_Type string, "
                               "Weather_Condition string, Traffic_Density string, s double, Actual_Delay_Days int")
    return df.withColumns({c: F.when(F.col("Shipment_ID") == "S3", F.lit(v)).otherwise(F.col(c)) for c, v in change.items()})


@pytest.mark.parametrize("change", [{"Weather_Condition": "Fog"}, {"Distance_km": None}, {"s": None}, {"s": float("nan")}])
def test_a_plan_needs_every_cost(spark, change):
    with pytest.raises(InfeasiblePlanError, match="without emission, freight or risk"):
        allocation.build_wide(panel(spark, **change), panels.risk_columns(1.0, dict.fromkeys(P.VEHICLES, 0.0), "s"))


def test_ranked_plan_needs_every_weight(spark):
    df = panel(spark, Distance_km=None)
    with pytest.raises(InfeasiblePlanError, match="have no ton_km"):
        allocation.minimum_freight_plan(df, panels.caps_dict(panels.observed_caps(df)))


def test_calibration_needs_every_score(spark):
    with pytest.raises(IntegrityError, match="no score"):
        calibrate.fit_vehicle_calibrations(panel(spark, s=None), "s", min_rows=2)


def test_a_plan_holds_all_rows():
    plan = allocation.Plan(None, 1.0, 1.0, {"a": 10.0, "b": 5.0})
    assert plan.meets({"a": 10, "b": 5}, 15) and not plan.meets({"a": 10, "b": 5}, 16)


def test_a_route_key_that_is_taken(spark, tiny_raw):
    old = star.dim_route(tiny_raw)
    other = tiny_raw.limit(1).withColumn("Origin", F.lit("Elsewhere"))
    clash = old.limit(1).withColumn("Route_ID", F.lit(star.dim_route(other).first()["Route_ID"]))
    with pytest.raises(PySparkException, match="two routes have the key"):
        star.new_routes(clash, other).collect()
    assert star.new_routes(old, tiny_raw.union(other)).count() == 1


def test_unreadable_rows_are_set_apart(spark, tiny_raw):
    src = fresh_path(spark, "raw") + "_csv"
    bad = tiny_raw.limit(1).select(*[F.lit("far").alias(c) if c == "Distance_km" else F.col(c).cast("string").alias(c) for c in tiny_raw.columns])
    writers.export_csv(tiny_raw.select(*[F.col(c).cast("string").alias(c) for c in tiny_raw.columns]).union(bad), src, "Shipment_ID", files=1)
    assert readers.load_raw(spark, src).count() == 6
    assert [r["unreadable"] for r in readers.quarantined(spark, src).collect()] == [["Distance_km"]]
    out = fresh_path(spark, "etl")
    assert jobs.run_etl(spark, src, out)["fact"].count() == 6
    assert spark.read.parquet(f"{out}/quarantine").count() == 1
    short = fresh_path(spark, "raw") + "_csv"
    writers.export_csv(tiny_raw.withColumn("Weather_Condition", F.lit("Fog")), short, "Shipment_ID", files=1)
    with pytest.raises(IntegrityError, match="Weather_Condition in set"):
        jobs.run_etl(spark, short, fresh_path(spark, "etl"))

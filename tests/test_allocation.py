import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError, ThinCalibrationError, VehicleEffectError
from cargolume.operators import allocation as al
from cargolume.operators import calibrate, panels


@pytest.fixture(scope="module")
def shipments(spark):
    rng = np.random.default_rng(8)
    rows = [(f"S{i:03d}", float(rng.uniform(60, 1500)), float(rng.uniform(0.5, 25)), P.VEHICLES[rng.choice(3, p=[.5, .2, .3])],
             P.WEATHER[rng.integers(4)], P.TRAFFIC[rng.integers(3)], float(rng.uniform(0.05, 0.9))) for i in range(240)]
    schema = "Shipment_ID string, Distance_km double, Weight_tons double, Vehicle_Type string, Weather_Condition string, Traffic_Density string, score double"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def caps(shipments):
    return panels.caps_dict(panels.observed_caps(shipments))


@pytest.fixture(scope="module")
def wide(shipments):
    return al.build_wide(shipments)


@pytest.fixture(scope="module")
def loose(wide, caps):
    return al.allocate(wide, caps)


@pytest.fixture(scope="module")
def greenest(wide, caps):
    return al.minimum_emission_plan(wide, caps)


def test_panel_covers_all_and_varies_the_vehicle_only(shipments):
    grid = panels.counterfactual_grid(shipments)
    assert grid.count() == 720 and grid.groupBy("Shipment_ID").agg(F.count_distinct("Distance_km").alias("n")).where("n > 1").count() == 0
    assert panels.stacked_grid(shipments).select(*sorted(grid.columns)).exceptAll(grid.select(*sorted(grid.columns))).count() == 0
    assert panels.emission_panel(shipments).where("co2_kg <= 0").count() == 0


def test_ranking_equals_the_dual(shipments, caps, loose):
    plan = al.minimum_freight_plan(shipments, caps)
    cost = al.plan_summary(plan, panels.allocation_panel(shipments)).agg(F.sum("freight")).first()[0]
    assert loose.lower_bound <= cost + 1e-6 and cost == pytest.approx(loose.lower_bound, rel=1e-6)
    assert {r["Vehicle_Type"]: r["count"] for r in plan.groupBy("Vehicle_Type").count().collect()} == caps


def test_ranking_is_the_best_of_all(spark):
    rng = np.random.default_rng(4)
    for trial in range(3):
        km = rng.uniform(10, 9000, 7).round(1)
        df = spark.createDataFrame([(f"S{i}", float(v)) for i, v in enumerate(km)], "Shipment_ID string, ton_km double")
        caps = dict(zip(P.VEHICLES, [(3, 2, 2), (0, 7, 0), (1, 0, 6)][trial]))
        got = {r["Shipment_ID"]: r["Vehicle_Type"] for r in al.ranked_assignment(df, caps).collect()}
        def cost(vs):
            return sum(km[i] * P.FREIGHT_RATE[v] + P.FREIGHT_FIXED[v] for i, v in enumerate(vs))
        pool = [v for v, n in caps.items() for _ in range(n)]
        best = min(cost(vs) for vs in set(itertools.permutations(pool)))
        assert cost([got[f"S{i}"] for i in range(7)]) == pytest.approx(best)


def test_ranking_with_one_hot_value(spark):
    df = spark.range(500).select(F.concat(F.lit("S"), "id").alias("Shipment_ID"), F.when(F.col("id") < 400, 10.0).otherwise(F.col("id") * 1.0).alias("ton_km"))
    caps = {"Diesel Truck": 150, "Electric Semi": 250, "Hybrid Van": 100}
    got = {r["Vehicle_Type"]: r["count"] for r in al.ranked_assignment(df, caps).groupBy("Vehicle_Type").count().collect()}
    assert got == caps


def test_every_shipment_once_and_caps_hold(loose, greenest, caps):
    for plan in (loose, greenest):
        totals = plan.assignment.groupBy("Shipment_ID").agg(F.sum("share").alias("s"))
        assert totals.count() == 240 and totals.where("abs(s - 1) > 1e-6").count() == 0
        assert all(plan.counts[v] <= caps[v] + 1e-6 for v in caps) and plan.fractional_shipments == 0
        assert -1e-9 < plan.gap < 1e-3


def test_no_worse_than_the_status_quo(shipments, loose):
    quo = panels.status_quo(shipments).agg(F.sum("freight"), F.sum("co2_kg")).first()
    assert loose.freight <= quo[0] + 1e-6


def test_ceiling_binds_and_has_a_price(wide, caps, loose, greenest):
    ceiling = 0.5 * (loose.co2_kg + greenest.co2_kg)
    plan = al.allocate(wide, caps, ceiling, whole=False, greenest=greenest)
    assert plan.co2_kg <= ceiling * (1 + 1e-7) and plan.shadow_price_per_ton > 0
    assert plan.freight >= loose.lower_bound - 1e-6 and -1e-7 < plan.gap <= al.MAX_GAP
    assert all(plan.counts[v] <= caps[v] + 1e-4 for v in caps)
    totals = plan.assignment.groupBy("Shipment_ID").agg(F.sum("share").alias("s"))
    assert totals.count() == 240 and totals.where("abs(s - 1) > 1e-6").count() == 0
    whole = al.allocate(wide, caps, ceiling, greenest=greenest)
    assert whole.co2_kg <= ceiling * (1 + 1e-7) and whole.freight >= plan.lower_bound - 1e-6


def test_slack_ceiling_is_free(wide, caps, loose, greenest):
    plan = al.allocate(wide, caps, loose.co2_kg * 1.1, greenest=greenest)
    assert plan.shadow_price_per_ton == pytest.approx(0.0, abs=1e-6)


def test_impossible_requests_raise(wide, caps, greenest):
    with pytest.raises(InfeasiblePlanError):
        al.allocate(wide, caps, 1.0, greenest=greenest)
    with pytest.raises(InfeasiblePlanError):
        al.allocate(wide, {v: 10 for v in caps})


def test_roomy_caps_let_prices_fall_to_zero(wide):
    plan = al.allocate(wide, {v: 240 for v in P.VEHICLES}, whole=False)
    best = wide.agg(F.sum(F.least("f0", "f1", "f2"))).first()[0]
    assert plan.lower_bound == pytest.approx(best, rel=1e-6) and plan.objective == pytest.approx(best, rel=1e-3)


def test_dual_bound_against_brute_force(spark, shipments):
    few = shipments.limit(7)
    wide = al.build_wide(few)
    caps = {"Diesel Truck": 3, "Electric Semi": 2, "Hybrid Van": 2}
    rows = wide.collect()
    plans = [p for p in itertools.product(range(3), repeat=7) if all(p.count(i) <= caps[v] for i, v in enumerate(P.VEHICLES))]
    def total(p, c):
        return sum(r[f"{c}{i}"] for r, i in zip(rows, p))
    green = min(total(p, "e") for p in plans)
    found = al.minimum_emission_plan(wide, caps, whole=False, tightness=1e-5)
    assert found.lower_bound == pytest.approx(green, rel=1e-4) and found.co2_kg == pytest.approx(green, rel=1e-3)
    ceiling = green * 1.15
    best = min(total(p, "f") for p in plans if total(p, "e") <= ceiling)
    plan = al.allocate(wide, caps, ceiling, whole=False, tightness=1e-5)
    assert plan.lower_bound <= best + 1e-6 and plan.freight <= best * (1 + 1e-3) and plan.co2_kg <= ceiling * (1 + 1e-6)


def test_frontier_is_monotone(spark, wide, caps):
    plans = al.frontier(wide, caps, points=3, whole=False)
    assert len(plans) == 3
    for p in plans:  # the last ceiling is the greenest plan itself
        assert p.meets(caps, wide.count()) and p.co2_kg <= p.epsilon_kg * (1 + 1e-9) and p.gap > -1e-6
    ordered = sorted(plans, key=lambda p: p.epsilon_kg)
    assert all(a.lower_bound >= b.lower_bound - 1e-6 for a, b in zip(ordered, ordered[1:]))
    table = al.marginal_abatement(al.frontier_table(spark, plans)).where("marginal_cost_per_kg IS NOT NULL")
    assert table.where("marginal_cost_per_kg < -1e-6").count() == 0


def test_late_penalty_steers_the_plan(shipments, caps):
    levels = {"Diesel Truck": -1.0, "Electric Semi": 0.0, "Hybrid Van": 1.0}
    wide = al.build_wide(shipments, panels.risk_columns(1.0, levels, "score"))
    calm = al.allocate(wide, caps, penalty=0.0, whole=False)
    keen = al.allocate(wide, caps, penalty=50_000.0, whole=False)
    assert keen.expected_delays < calm.expected_delays and keen.freight > calm.freight


def test_missing_risk_is_an_error(shipments):
    risk = panels.risk_panel(shipments.limit(200), 1.0, {v: 0.0 for v in P.VEHICLES}, "score")
    with pytest.raises(InfeasiblePlanError, match="40 shipments"):
        panels.require_risk(panels.align_risk(panels.emission_panel(shipments), risk))


def test_guard_passes_and_fails(shipments):
    same = shipments.select("Shipment_ID", *panels.risk_columns(1.0, {v: 0.1 for v in P.VEHICLES}, "score"))
    assert panels.require_guard(panels.calibrated_guard(same)).first()["worst_spread"] < 1e-12
    apart = shipments.select("Shipment_ID", *panels.risk_columns(1.0, {"Diesel Truck": 0.0, "Electric Semi": 1.0, "Hybrid Van": 0.0}, "score"))
    with pytest.raises(VehicleEffectError):
        panels.require_guard(panels.calibrated_guard(apart))


def test_calibrated_means_reproduce_rates(spark):
    rows = []
    rng = np.random.default_rng(2)
    for v, rate in zip(P.VEHICLES, (0.2, 0.35, 0.1)):
        s = rng.uniform(0.02, 0.98, 400)
        late = rng.random(400) < s * rate * 2
        rows += [(f"{v}{i}", float(a), v, int(b)) for i, (a, b) in enumerate(zip(s, late))]
    df = spark.createDataFrame(rows, "Shipment_ID string, Delay_Risk_Probability double, Vehicle_Type string, Actual_Delay_Days int")
    fitted = calibrate.fit_vehicle_calibrations(df)
    assert len({c.slope for c in fitted.values()}) == 1
    for c in fitted.values():
        assert c.mean_calibrated == pytest.approx(c.observed_delay_rate, abs=1e-4) and c.n_rows == 400
    with pytest.raises(ThinCalibrationError, match="fewer than"):
        calibrate.fit_vehicle_calibrations(df.where("Vehicle_Type <> 'Hybrid Van' OR Shipment_ID LIKE '%1'"))
    with pytest.raises(ThinCalibrationError, match="Actual_Delay_Days"):
        calibrate.fit_vehicle_calibrations(df.drop("Actual_Delay_Days"))

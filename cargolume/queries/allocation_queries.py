"""Queries on panels, guards and vehicle allocation."""

from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.operators import allocation as al
from cargolume.operators import calibrate, panels
from cargolume.queries.base import query, with_ship
from cargolume.queries.formula_queries import CO2_INPUTS, r
from cargolume.queries.metric_queries import SCORED, rounded, scored_view
from cargolume.session import literal_rows, materialise
from cargolume.sources.shipments import shipments

INPUTS = ["Shipment_ID", *CO2_INPUTS]
FLEET = """fleet(k, rate, fixed, factor, base, b_low, b_high) AS (VALUES
  ('Diesel Truck', 0.085::DOUBLE, 42.0::DOUBLE, 0.13::DOUBLE, 8.0::DOUBLE, -0.10::DOUBLE, -0.10::DOUBLE),
  ('Electric Semi', 0.062::DOUBLE, 96.0::DOUBLE, 0.035::DOUBLE, 1.5::DOUBLE, 0.00::DOUBLE, 0.40::DOUBLE),
  ('Hybrid Van', 0.098::DOUBLE, 28.0::DOUBLE, 0.08::DOUBLE, 4.0::DOUBLE, 0.05::DOUBLE, 0.05::DOUBLE))"""
PANEL = """panel AS (SELECT Shipment_ID, Vehicle_Type AS actual, k AS Vehicle_Type, Distance_km * Weight_tons AS ton_km,
  greatest((Distance_km * Weight_tons * factor + base)
    * CASE Weather_Condition WHEN 'Normal' THEN 1.0::DOUBLE WHEN 'Rain' THEN 1.03::DOUBLE WHEN 'Storm' THEN 1.08::DOUBLE ELSE 1.06::DOUBLE END
    * CASE Traffic_Density WHEN 'Low' THEN 1.0::DOUBLE WHEN 'Medium' THEN 1.04::DOUBLE ELSE 1.1::DOUBLE END, 0.5::DOUBLE) AS co2_kg,
  Distance_km * Weight_tons * rate + fixed AS freight,
  1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.9::DOUBLE * ln(raw_score / (1.0::DOUBLE - raw_score)) + b_low))) AS p,
  1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.9::DOUBLE * ln(raw_score / (1.0::DOUBLE - raw_score)) + b_high))) AS p_high
  FROM ship, fleet)"""
SLOPE = 0.9
LOW = {"Diesel Truck": -0.10, "Electric Semi": 0.00, "Hybrid Van": 0.05}
HIGH = {"Diesel Truck": -0.10, "Electric Semi": 0.40, "Hybrid Van": 0.05}


@query("counterfactual_grid", with_ship("SELECT Shipment_ID, Weather_Condition, k AS Vehicle_Type FROM ship, fleet", FLEET))
def counterfactual_grid(spark, sf):
    return panels.counterfactual_grid(shipments(spark, sf, ["Shipment_ID", "Weather_Condition", "Vehicle_Type"]))


@query("stacked_counterfactuals", with_ship("SELECT k AS Vehicle_Type, Weather_Condition, count(*) AS shipments FROM ship, fleet GROUP BY ALL", FLEET))
def stacked_counterfactuals(spark, sf):
    df = panels.stacked_grid(shipments(spark, sf, ["Weather_Condition", "Vehicle_Type"]))
    return df.groupBy("Vehicle_Type", "Weather_Condition").agg(F.count("*").alias("shipments"))


@query("emission_panel", with_ship("SELECT Shipment_ID, Vehicle_Type, co2_kg FROM panel", FLEET, PANEL))
def emission_panel(spark, sf):
    return panels.emission_panel(shipments(spark, sf, INPUTS))


@query("freight_panel", with_ship("SELECT Shipment_ID, Vehicle_Type, freight FROM panel", FLEET, PANEL))
def freight_panel(spark, sf):
    return panels.freight_panel(shipments(spark, sf, ["Shipment_ID", "Distance_km", "Weight_tons", "Vehicle_Type"]))


@query("status_quo", with_ship("""
SELECT Vehicle_Type, count(*) AS shipments, round(sum(co2_kg), 4) AS co2_kg, round(sum(freight), 4) AS freight
FROM panel WHERE actual = Vehicle_Type GROUP BY 1""", FLEET, PANEL))
def status_quo(spark, sf):
    return rounded(panels.status_quo(shipments(spark, sf, CO2_INPUTS)), 4)


@query("observed_fleet_caps", with_ship("SELECT k AS Vehicle_Type, count(Shipment_ID) AS cap FROM fleet LEFT JOIN ship ON Vehicle_Type = k GROUP BY 1", FLEET))
def observed_fleet_caps(spark, sf):
    return panels.observed_caps(shipments(spark, sf, ["Vehicle_Type"]))


GUARD_SQL = """SELECT round(spread, 6) AS worst_spread, Shipment_ID AS worst_shipment, spread < 0.05 AS passed, (SELECT count(DISTINCT Shipment_ID) FROM panel) AS shipments,
  round((SELECT avg({p}) FROM panel WHERE Vehicle_Type = 'Diesel Truck'), 6) AS mean_diesel, round((SELECT avg({p}) FROM panel WHERE Vehicle_Type = 'Electric Semi'), 6) AS mean_electric,
  round((SELECT avg({p}) FROM panel WHERE Vehicle_Type = 'Hybrid Van'), 6) AS mean_hybrid
FROM (SELECT Shipment_ID, max({p}) - min({p}) AS spread FROM panel GROUP BY 1) ORDER BY spread DESC, Shipment_ID LIMIT 1"""


def _guard(verdict):
    means = F.col("vehicle_means")
    return rounded(verdict.select("worst_spread", "worst_shipment", "passed", "shipments", *[
        means[v].alias(n) for v, n in zip(P.VEHICLES, ("mean_diesel", "mean_electric", "mean_hybrid"))]))


def _risk_wide(spark, sf, levels):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    # Equal scores must tie exactly in both engines, whatever the last bit of exp is.
    return df.select("Shipment_ID", *[F.round(c, 9).alias(f"p{i}") for i, c in enumerate(
        panels.risk_columns(SLOPE, levels, "raw_score"))])


GUARD_ROUND = "panel AS (SELECT Shipment_ID, Vehicle_Type, round(p, 9) AS p, round(p_high, 9) AS p_high FROM panel0)"


@query("vehicle_guard_calibrated", with_ship(GUARD_SQL.format(p="p"), FLEET, PANEL.replace("panel AS", "panel0 AS", 1), GUARD_ROUND))
def vehicle_guard_calibrated(spark, sf):
    return _guard(panels.calibrated_guard(_risk_wide(spark, sf, LOW).select(
        "Shipment_ID", *[F.col(f"p{i}") for i in range(3)])))


@query("vehicle_guard_failing", with_ship(GUARD_SQL.format(p="p_high"), FLEET, PANEL.replace("panel AS", "panel0 AS", 1), GUARD_ROUND))
def vehicle_guard_failing(spark, sf):
    """The long form of the guard, on intercepts that break the bound."""
    df = shipments(spark, sf, ["Shipment_ID", "raw_score", "Vehicle_Type"])
    long = panels.risk_panel(df, SLOPE, HIGH, "raw_score").withColumn("p", F.round("p", 9))
    return _guard(panels.vehicle_guard(long))


@query("vehicle_group_leak", with_ship("""
SELECT CAST(sum(n) AS BIGINT) AS shipments, count(*) AS vehicles, round(max(m) - min(m), 6) AS leak, max(m) - min(m) < 0.05 AS passed
FROM (SELECT Vehicle_Type, count(*) AS n, avg(p) AS m FROM scored GROUP BY 1)""", SCORED))
def vehicle_group_leak(spark, sf):
    return rounded(panels.group_mean_leak(scored_view(spark, sf, ["Vehicle_Type"])))


@query("risk_panel", with_ship("SELECT Shipment_ID, Vehicle_Type, round(p, 6) AS p FROM panel", FLEET, PANEL))
def risk_panel(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score", "Vehicle_Type"])
    return rounded(panels.risk_panel(df, SLOPE, LOW, "raw_score"))


@query("shipments_missing_risk", with_ship("""
SELECT Shipment_ID, count(*) AS missing_vehicles FROM panel JOIN (SELECT Shipment_ID AS s, Weight_tons FROM ship) ON s = Shipment_ID
WHERE Weight_tons > 23 AND Vehicle_Type <> 'Diesel Truck' GROUP BY 1""", FLEET, PANEL))
def shipments_missing_risk(spark, sf):
    df = shipments(spark, sf, [*INPUTS, "raw_score"])
    risk = panels.risk_panel(df, SLOPE, LOW, "raw_score")
    light = df.where("Weight_tons <= 23").select("Shipment_ID")
    known = risk.join(light, "Shipment_ID", "left_semi").unionByName(
        risk.join(light, "Shipment_ID", "left_anti").where("Vehicle_Type = 'Diesel Truck'"))
    return panels.missing_risk(panels.align_risk(panels.emission_panel(df), known))


RANKED = """ranked AS (SELECT Shipment_ID, CASE WHEN rn <= e THEN 'Electric Semi' WHEN rn <= e + d THEN 'Diesel Truck' ELSE 'Hybrid Van' END AS Vehicle_Type
  FROM (SELECT Shipment_ID, row_number() OVER (ORDER BY Distance_km * Weight_tons DESC, sha1(Shipment_ID)) AS rn FROM ship),
  (SELECT count_if(Vehicle_Type = 'Electric Semi') AS e, count_if(Vehicle_Type = 'Diesel Truck') AS d FROM ship))"""


def _ranked(spark, sf, extra=()):
    df = materialise(shipments(spark, sf, [*INPUTS, *extra]), "ranked")
    caps = panels.caps_dict(panels.observed_caps(df))
    return df, al.minimum_freight_plan(df, caps)


@query("minimum_freight_plan", with_ship("SELECT Shipment_ID, Vehicle_Type, 1.0::DOUBLE AS share FROM ranked", RANKED))
def minimum_freight_plan(spark, sf):
    return _ranked(spark, sf)[1]


SUMMARY = """summary AS (SELECT Vehicle_Type, count(*)::DOUBLE AS shipments, sum(freight) AS freight, sum(co2_kg) AS co2_kg, sum(p) AS expected_late
  FROM ranked JOIN panel USING (Shipment_ID, Vehicle_Type) GROUP BY 1)"""


@query("plan_summary", with_ship("""SELECT Vehicle_Type, shipments, round(freight, 4) AS freight, round(co2_kg, 4) AS co2_kg, round(expected_late, 4) AS expected_late, 0 AS split_rows FROM summary""",
                                 FLEET, PANEL, RANKED, SUMMARY), longs=("split_rows",))
def plan_summary(spark, sf):
    df, plan = _ranked(spark, sf, ["raw_score"])
    by_id = df.repartition("Shipment_ID")
    risk = panels.risk_panel(by_id, SLOPE, LOW, "raw_score")
    return rounded(al.plan_summary(plan, panels.align_risk(panels.allocation_panel(by_id), risk)), 4)


@query("plan_abatement", with_ship("""
SELECT round(qe, 4) AS quo_co2_kg, round(qf, 4) AS quo_freight, round(pe, 4) AS plan_co2_kg, round(pf, 4) AS plan_freight, round(qe - pe, 4) AS saved_kg,
  round(100 * (pe - qe) / qe, 4) AS change_percent, round(qf - pf, 4) AS saved_freight
FROM (SELECT sum(co2_kg) AS qe, sum(freight) AS qf FROM panel WHERE actual = Vehicle_Type), (SELECT sum(co2_kg) AS pe, sum(freight) AS pf FROM summary)""",
    FLEET, PANEL, RANKED, SUMMARY))
def plan_abatement(spark, sf):
    df, plan = _ranked(spark, sf)
    return rounded(al.abatement(panels.status_quo(df), al.plan_summary(plan, panels.allocation_panel(df.repartition("Shipment_ID")))), 4)


@query("carbon_price_sweep", with_ship("""
SELECT price AS price_per_ton, round(sum(freight), 4) AS freight, round(sum(co2_kg), 4) AS co2_kg, count_if(Vehicle_Type = 'Diesel Truck') AS n_diesel_truck,
  count_if(Vehicle_Type = 'Electric Semi') AS n_electric_semi, count_if(Vehicle_Type = 'Hybrid Van') AS n_hybrid_van
FROM (SELECT *, row_number() OVER (PARTITION BY price, Shipment_ID ORDER BY freight + price / 1000.0::DOUBLE * co2_kg, Vehicle_Type) AS rn
  FROM panel, (VALUES (0.0::DOUBLE), (25.0::DOUBLE), (50.0::DOUBLE), (100.0::DOUBLE), (200.0::DOUBLE), (400.0::DOUBLE)) v(price)) WHERE rn = 1 GROUP BY 1""",
    FLEET, PANEL), longs=("n_diesel_truck", "n_electric_semi", "n_hybrid_van"))
def carbon_price_sweep(spark, sf):
    wide = panels.wide_panel(shipments(spark, sf, INPUTS))
    return rounded(al.carbon_price_sweep(wide, [0.0, 25.0, 50.0, 100.0, 200.0, 400.0]), 4)


@query("marginal_abatement_cost", with_ship("""
SELECT price, round(co2_kg, 4) AS epsilon_kg, round(freight, 4) AS freight, round((freight - lag(freight) OVER (ORDER BY co2_kg DESC)) / (lag(co2_kg) OVER (ORDER BY co2_kg DESC) - co2_kg), 6) AS marginal_cost_per_kg
FROM (SELECT price, sum(freight) AS freight, sum(co2_kg) AS co2_kg FROM (SELECT *, row_number() OVER (PARTITION BY price, Shipment_ID ORDER BY freight + price / 1000.0::DOUBLE * co2_kg, Vehicle_Type) AS rn
  FROM panel, (VALUES (0.0::DOUBLE), (100.0::DOUBLE), (400.0::DOUBLE), (1600.0::DOUBLE)) v(price)) WHERE rn = 1 GROUP BY 1)""", FLEET, PANEL))
def marginal_abatement_cost(spark, sf):
    wide = panels.wide_panel(shipments(spark, sf, INPUTS))
    points = al.carbon_price_sweep(wide, [0.0, 100.0, 400.0, 1600.0]).select(
        F.col("price_per_ton").alias("price"), F.col("co2_kg").alias("epsilon_kg"), "freight")
    out = al.marginal_abatement(points)
    return out.select("price", r("epsilon_kg", 4).alias("epsilon_kg"), r("freight", 4).alias("freight"),
                      r("marginal_cost_per_kg").alias("marginal_cost_per_kg"))


def _stored_panel(spark, sf, risk=False):
    """The stored inputs of the panel with the vehicles as they ran, and the panel: the view is joined once."""
    df = shipments(spark, sf, [*INPUTS, *(["raw_score"] if risk else [])])
    rows = al.panel_inputs(df, panels.risk_columns(SLOPE, LOW, "raw_score") if risk else None, ["Vehicle_Type"])
    return rows, al.widened(rows)


def _panel_and_caps(spark, sf, risk=False):
    rows, wide = _stored_panel(spark, sf, risk)
    return wide, panels.caps_dict(panels.observed_caps(rows))


def _figures(spark, plan):
    return literal_rows(
        spark, ["epsilon_kg", "freight", "co2_kg", "shadow_price_per_ton", "lower_bound", "objective", "gap",
                "expected_delays", "fractional_shipments"],
        [(plan.epsilon_kg, plan.freight, plan.co2_kg, plan.shadow_price_per_ton, plan.lower_bound, plan.objective,
          plan.gap, plan.expected_delays, plan.fractional_shipments)])


@query("minimum_emission_plan")
def minimum_emission_plan(spark, sf):
    wide, caps = _panel_and_caps(spark, sf)
    return al.minimum_emission_plan(wide, caps).assignment


@query("emission_ceiling_plan")
def emission_ceiling_plan(spark, sf):
    """Halfway between the greenest and the status-quo emissions, late penalty included."""
    rows, wide = _stored_panel(spark, sf, risk=True)
    caps = panels.caps_dict(panels.observed_caps(rows))
    green = al.minimum_emission_plan(wide, caps)
    quo = panels.status_quo(rows).agg(F.sum("co2_kg")).first()[0]
    return al.allocate(wide, caps, (green.co2_kg + quo) / 2, greenest=green).assignment


@query("emission_ceiling_figures")
def emission_ceiling_figures(spark, sf):
    wide, caps = _panel_and_caps(spark, sf)
    green = al.minimum_emission_plan(wide, caps)
    return _figures(spark, al.allocate(wide, caps, green.co2_kg * 1.1, greenest=green))


@query("cost_emission_frontier")
def cost_emission_frontier(spark, sf):
    wide, caps = _panel_and_caps(spark, sf)
    plans = al.frontier(wide, caps)
    return al.marginal_abatement(al.frontier_table(spark, plans))


def _observed(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Vehicle_Type", "raw_score", "Actual_Delay_Days"])
    return df.withColumnRenamed("raw_score", "Delay_Risk_Probability")


@query("vehicle_calibrations")
def vehicle_calibrations(spark, sf):
    observed = materialise(_observed(spark, sf), "observed")
    return calibrate.calibration_table(spark, calibrate.fit_vehicle_calibrations(observed))


@query("vehicle_guard_fitted")
def vehicle_guard_fitted(spark, sf):
    observed = materialise(_observed(spark, sf), "observed")
    slope, levels = calibrate.intercepts(calibrate.fit_vehicle_calibrations(observed))
    wide = observed.select("Shipment_ID", *panels.risk_columns(slope, levels))
    return panels.calibrated_guard(wide)



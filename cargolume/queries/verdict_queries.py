"""What can be said in SQL of results that SQL cannot compute: ids complete, bounds met, sizes and observed rates.

Each query runs the operator over the whole view and holds its result against what the tables say.
"""

import math

from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions import formulas as fx
from cargolume.operators import allocation as al
from cargolume.operators import fingerprint, kpis, metrics, model, rolling, splits, vendors
from cargolume.queries import allocation_queries as aq
from cargolume.queries import job_queries as jq
from cargolume.queries.base import REGISTRY, query, with_ship
from cargolume.queries.metric_queries import dated
from cargolume.session import fresh_path, literal_rows, materialise
from cargolume.sources.shipments import shipments

PROBABLE = "probability BETWEEN 0 AND 1"
CAPS_SQL = "SELECT Vehicle_Type, count(*) AS cap, count(*) AS planned FROM ship GROUP BY 1"


# --- folds and draws ----------------------------------------------------------------------------------

@query("vendor_grouped_folds_verdict", with_ship("SELECT count(*) AS shipments, count(DISTINCT Vendor_ID) AS vendors, count(DISTINCT Vendor_ID) AS vendor_folds, 5 AS folds, true AS balanced FROM ship"))
def vendor_grouped_folds_verdict(spark, sf):
    """A vendor lies in one fold; the largest fold holds at most half again the mean."""
    d = materialise(splits.grouped_folds(dated(spark, sf, ["Vendor_ID"])), "folds")
    size = d.groupBy("fold").count().agg(F.max("count")).scalar()
    return d.agg(F.count("*").alias("shipments"), F.count_distinct("Vendor_ID").alias("vendors"), F.count_distinct("Vendor_ID", "fold").alias("vendor_folds"),
                 F.count_distinct("fold").cast("int").alias("folds")).withColumn("balanced", size <= F.col("shipments") / 5 * 1.5)


@query("delay_rate_offset_verdict", with_ship(f"SELECT count(*) AS shipments, {P.TARGET_DELAY_RATE}::DOUBLE AS mean_probability FROM ship"))
def delay_rate_offset_verdict(spark, sf):
    df = materialise(shipments(spark, sf, ["Vendor_Rating", "Distance_km", "Weather_Condition", "Traffic_Density"]).select(fx.delay_index().alias("x")), "index")
    offset = kpis.solve_offset(df, "x")
    return df.agg(F.count("*").alias("shipments"), F.round(F.avg(fx.sigmoid(F.col("x") + offset)), 6).alias("mean_probability"))


@query("assigned_vehicles_verdict", with_ship("SELECT count(*) AS shipments, count(DISTINCT Shipment_ID) AS ids, 3 AS vehicles, 0 AS unknown, true AS drawn_as_probable FROM ship"))
def assigned_vehicles_verdict(spark, sf):
    """The drawn shares lie within 3 standard deviations of the mean probabilities."""
    drawn, chance = (REGISTRY[n][0](spark, sf) for n in ("assigned_vehicles", "vehicle_probabilities"))  # each is read once, so neither is stored
    mean = {r["option"]: (r["p"], r["n"]) for r in chance.groupBy("option").agg(F.avg("probability").alias("p"), F.count("*").alias("n")).collect()}
    shares = [F.abs(F.avg((F.col("Vehicle_Type") == v).cast("double")) - mean[i][0]) <= 3 * math.sqrt(mean[i][0] * (1 - mean[i][0]) / mean[i][1]) + 1e-9 for i, v in enumerate(P.VEHICLES)]
    return drawn.agg(F.count("*").alias("shipments"), F.count_distinct("Shipment_ID").alias("ids"), F.count_distinct("Vehicle_Type").cast("int").alias("vehicles"),
                     F.count_if(~F.col("Vehicle_Type").isin(P.VEHICLES)).cast("int").alias("unknown"), (shares[0] & shares[1] & shares[2]).alias("drawn_as_probable"))


@query("vehicle_probabilities_verdict", with_ship("SELECT count(*) AS shipments, 3 * count(*) AS rows, 0 AS outside, true AS sums_to_one FROM ship"))
def vehicle_probabilities_verdict(spark, sf):
    per = REGISTRY["vehicle_probabilities"][0](spark, sf).groupBy("Shipment_ID").agg(
        F.sum("probability").alias("s"), F.count("*").alias("n"), F.count_if(~F.col("probability").between(0.0, 1.0)).alias("out"))
    return per.agg(F.count("*").alias("shipments"), F.sum("n").alias("rows"), F.sum("out").cast("int").alias("outside"), (F.max(F.abs(F.col("s") - 1)) < 1e-9).alias("sums_to_one"))


@query("drawn_delay_days_verdict", with_ship("SELECT count(*) AS shipments, count(DISTINCT Shipment_ID) AS ids, 0 AS outside, true AS late_as_probable FROM ship"))
def drawn_delay_days_verdict(spark, sf):
    rate = shipments(spark, sf, ["raw_score"]).agg(F.avg("raw_score").alias("p"), F.avg(F.col("raw_score") * (1 - F.col("raw_score"))).alias("v")).first()
    d = REGISTRY["drawn_delay_days"][0](spark, sf)
    late = F.avg((F.col("Delay_Days") > 0).cast("double"))
    return d.agg(F.count("*").alias("shipments"), F.count_distinct("Shipment_ID").alias("ids"), F.count_if(~F.col("Delay_Days").between(0, P.MAX_DELAY_DAYS)).cast("int").alias("outside"),
                 (F.abs(late - rate["p"]) <= 4 * F.sqrt(F.lit(rate["v"]) / F.count("*"))).alias("late_as_probable"))


# --- fingerprints -------------------------------------------------------------------------------------

STAR_ROWS = """SELECT 'fact' AS "table", count(*) AS rows FROM ship UNION ALL SELECT 'dim_vendor', count(DISTINCT Vendor_ID) FROM ship
UNION ALL SELECT 'dim_route', count(*) FROM (SELECT DISTINCT Origin, Destination, Vehicle_Type, Weather_Condition, Traffic_Density FROM ship)
UNION ALL SELECT 'dim_date', date_diff('day', min(CAST(Shipment_Date AS DATE)), max(CAST(Shipment_Date AS DATE))) + 1 FROM ship"""


@query("table_fingerprints_verdict", with_ship(f'SELECT "table", rows, true AS stable, true AS sees_a_change FROM ({STAR_ROWS})'))
def table_fingerprints_verdict(spark, sf):
    """A digest does not depend on the partitions, and one row less changes it."""
    tables = {n: materialise(t, n) for n, t in jq.star_tables(spark, sf).items()}
    digests = [{r["table"]: r["digest"] for r in fingerprint.fingerprints(x).collect()} for x in (
        tables, {n: t.repartition(*t.columns) for n, t in tables.items()}, {n: t.where(t[t.columns[0]] != t.agg(F.min(t.columns[0])).first()[0]) for n, t in tables.items()})]
    return literal_rows(spark, ["table", "rows", "stable", "sees_a_change"], [(n, t.count(), digests[0][n] == digests[1][n], digests[0][n] != digests[2][n]) for n, t in tables.items()]).withColumn("rows", F.col("rows").cast("long"))


@query("load_audit_manifest_verdict", with_ship(f'SELECT "table", rows, CASE WHEN "table" = \'dim_vendor\' THEN rows END AS stamped_rows FROM ({STAR_ROWS})'))
def load_audit_manifest_verdict(spark, sf):
    return REGISTRY["load_audit_manifest"][0](spark, sf).select("table", "rows", "stamped_rows")


# --- allocation ---------------------------------------------------------------------------------------

def _counted(assignment, caps):
    """Shipments per vehicle next to the caps; a shipment that is planned twice or not at all shows in the counts."""
    planned = {r["Vehicle_Type"]: r["n"] for r in assignment.groupBy("Vehicle_Type").agg(F.count_distinct("Shipment_ID").alias("n")).collect()}
    return [(v, int(c), int(planned.get(v, 0))) for v, c in caps.items()]


def _planned(spark, plan, caps):
    rows = [(*r, bool(-1e-9 < plan.gap <= al.MAX_GAP), plan.epsilon_kg is None or plan.co2_kg <= plan.epsilon_kg * (1 + 1e-9)) for r in _counted(plan.assignment, caps)]
    return literal_rows(spark, ["Vehicle_Type", "cap", "planned", "near_bound", "ceiling_met"], rows).withColumns({c: F.col(c).cast("long") for c in ("cap", "planned")})


PLANNED_SQL = with_ship(f"SELECT Vehicle_Type, cap, planned, true AS near_bound, true AS ceiling_met FROM ({CAPS_SQL})")


@query("minimum_emission_plan_verdict", PLANNED_SQL)
def minimum_emission_plan_verdict(spark, sf):
    """All caps bind, so every vehicle carries exactly its cap."""
    wide, caps = aq._panel_and_caps(spark, sf)
    return _planned(spark, al.minimum_emission_plan(wide, caps), caps)


@query("emission_ceiling_plan_verdict", PLANNED_SQL)
def emission_ceiling_plan_verdict(spark, sf):
    wide, caps = aq._panel_and_caps(spark, sf)
    green = al.minimum_emission_plan(wide, caps)
    return _planned(spark, al.allocate(wide, caps, green.co2_kg * 1.1, greenest=green), caps)


@query("emission_ceiling_figures_verdict", with_ship("SELECT count(*) AS shipments, true AS ceiling_met, true AS priced, true AS near_bound, 0 AS split FROM ship"))
def emission_ceiling_figures_verdict(spark, sf):
    wide, caps = aq._panel_and_caps(spark, sf)
    green = al.minimum_emission_plan(wide, caps)
    p = al.allocate(wide, caps, green.co2_kg * 1.05, greenest=green)
    row = (int(round(sum(p.counts.values()))), p.co2_kg <= p.epsilon_kg * (1 + 1e-9), p.shadow_price_per_ton > 0, bool(-1e-9 < p.gap <= al.MAX_GAP), p.fractional_shipments)
    return literal_rows(spark, ["shipments", "ceiling_met", "priced", "near_bound", "split"], [row]).withColumn("shipments", F.col("shipments").cast("long"))


@query("cost_emission_frontier_verdict", with_ship("SELECT CAST(k AS INTEGER) AS point, n AS shipments, true AS proven, true AS ceiling_met, true AS near_bound, true AS monotone FROM (SELECT count(*) AS n FROM ship), range(12) r(k)"))
def cost_emission_frontier_verdict(spark, sf):
    """12 ceilings: all proven, met, within the gap, and no bound below that of a looser ceiling."""
    wide, caps = aq._panel_and_caps(spark, sf)
    plans = al.frontier(wide, caps)
    rows = [(k, int(round(sum(p.counts.values()))), p.state == "proven", bool(p.co2_kg <= p.epsilon_kg * (1 + 1e-9)), bool(-1e-9 < p.gap <= al.MAX_GAP),
             k == 0 or bool(p.lower_bound >= plans[k - 1].lower_bound * (1 - 1e-5))) for k, p in enumerate(plans)]
    return literal_rows(spark, ["point", "shipments", "proven", "ceiling_met", "near_bound", "monotone"], rows).withColumn("shipments", F.col("shipments").cast("long"))


@query("vehicle_calibrations_verdict", with_ship("SELECT Vehicle_Type AS vehicle, CAST(count(*) AS INTEGER) AS n_rows, round(avg((Actual_Delay_Days > 0)::INT), 4) AS fitted_rate, 1 AS slopes FROM ship GROUP BY 1"))
def vehicle_calibrations_verdict(spark, sf):
    """The fitted mean of every vehicle is its observed rate, and all share one slope."""
    t = REGISTRY["vehicle_calibrations"][0](spark, sf)
    slopes = t.agg(F.count_distinct("slope")).scalar()
    return t.select("vehicle", F.col("n_rows").cast("int").alias("n_rows"), F.round("mean_calibrated", 4).alias("fitted_rate"), slopes.cast("int").alias("slopes"))


@query("vehicle_guard_fitted_verdict", with_ship("SELECT count(*) AS shipments, true AS decided FROM ship"))
def vehicle_guard_fitted_verdict(spark, sf):
    """The verdict is the worst spread against its bound."""
    t = REGISTRY["vehicle_guard_fitted"][0](spark, sf)
    return t.select(F.col("shipments").cast("long").alias("shipments"), (F.col("worst_spread").between(0.0, 1.0) & (F.col("passed") == (F.col("worst_spread") < P.MAX_VEHICLE_SPREAD))).alias("decided"))


# --- vendors and weeks --------------------------------------------------------------------------------

def _vendor_dimension(means):
    """Vendors with their mean rating, a rate that rises with it, and bounds around their present volume."""
    rows = means.collect()
    return [vendors.Vendor(r["Vendor_ID"], r["rating"], 0.85 + 0.06 * r["rating"], math.ceil(1.25 * r["n"]), math.floor(0.5 * r["n"])) for r in rows]


def _vendor_plan(spark, sf):
    """With a service level 3 % better than that of the vendors as they are now."""
    df = shipments(spark, sf, ["Shipment_ID", "Vendor_ID", "Vendor_Rating", "Distance_km", "Weight_tons", "Weather_Condition", "Traffic_Density", "Vehicle_Type"])
    df = materialise(df, "vendor-view")
    means = materialise(df.groupBy("Vendor_ID").agg(F.avg("Vendor_Rating").alias("rating"), F.count("*").alias("n")), "vendor-means")
    now = df.drop("Vendor_Rating").join(means.select(F.col("Vendor_ID").alias("v"), F.col("rating").alias("Vendor_Rating")), F.col("Vendor_ID").eqNullSafe(F.col("v")))
    service, dim = 0.97 * now.agg(F.avg(fx.sigmoid(fx.delay_index() - 2.7))).first()[0], _vendor_dimension(means)
    return vendors.assign_vendors(df, dim, service=service, offset=-2.7), service, dim


@query("vendor_assignment")
def vendor_assignment(spark, sf):
    return _vendor_plan(spark, sf)[0].assignment


@query("vendor_assignment_verdict", with_ship("""SELECT Vendor_ID, CAST(ceil(1.25 * count(*)) AS BIGINT) AS cap, CAST(floor(0.5 * count(*)) AS BIGINT) AS floor, true AS within_bounds,
  (SELECT count(*) FROM ship) AS shipments, 0 AS not_whole, true AS service_met, true AS near_bound FROM ship GROUP BY 1"""))
def vendor_assignment_verdict(spark, sf):
    """Every vendor's load against its bounds; all shipments whole; the service level and the gap."""
    plan, service, dim = _vendor_plan(spark, sf)
    whole = plan.assignment.groupBy("Shipment_ID").agg(F.sum("share").alias("s")).agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("s") - 1) > 1e-9).alias("off")).first()
    loads = {r["Vendor_ID"]: r["s"] for r in plan.assignment.groupBy("Vendor_ID").agg(F.sum("share").alias("s")).collect()}
    rows = [(v.id, int(v.cap), int(v.floor), bool(v.floor * (1 - 1e-6) <= loads.get(v.id, 0.0) <= v.cap * (1 + 1e-6)), whole["n"], whole["off"],
             bool(plan.expected_late <= service * whole["n"]), bool(-1e-9 < plan.gap <= al.MAX_GAP)) for v in dim]
    return spark.createDataFrame(rows, "Vendor_ID string, cap long, floor long, within_bounds boolean, shipments long, not_whole int, service_met boolean, near_bound boolean")


def _rolling(spark, sf):
    df = shipments(spark, sf, [*aq.INPUTS, "Shipment_Date"]).withColumn("Full_Date", F.to_date("Shipment_Date"))
    rows = al.panel_inputs(df, keep=["Vehicle_Type", "Full_Date"])
    busiest = rows.groupBy(F.date_format("Full_Date", "yyyy-MM")).count().agg(F.max("count")).first()[0]
    fleet = {r["Vehicle_Type"]: r["n"] for r in rows.groupBy("Vehicle_Type").agg(F.count("*").alias("n")).collect()}
    monthly = {v: math.ceil(1.15 * busiest * fleet.get(v, 0) / sum(fleet.values())) + 1 for v in P.VEHICLES}
    wide = al.widened(rows, keep=["Full_Date"])
    # Days go to the panel by id. Where no id is repeated, each row keeps its own day and the join is left out.
    if rows.groupBy(F.xxhash64("Shipment_ID")).count().where("count > 1").limit(1).count():
        wide = materialise(wide.drop("Full_Date").join(rows.select("Shipment_ID", "Full_Date"), "Shipment_ID"), "rolling-view")
    return rolling.rolling_plan(wide, monthly, fresh_path(spark, "rolling")), monthly


@query("rolling_weekly_plan")
def rolling_weekly_plan(spark, sf):
    plan, _ = _rolling(spark, sf)
    return plan.assignment


@query("rolling_weekly_plan_verdict", with_ship("""SELECT strftime(CAST(Shipment_Date AS DATE), '%Y-%m') AS month, CAST(date_trunc('week', CAST(Shipment_Date AS DATE)) AS DATE) AS week,
  count(*) AS shipments, count(DISTINCT Shipment_ID) AS planned, false AS over_budget FROM ship GROUP BY 1, 2"""))
def rolling_weekly_plan_verdict(spark, sf):
    """Per week: all shipments are planned, and no vehicle's running use is above the month's capacity."""
    plan, monthly = _rolling(spark, sf)
    per = plan.assignment.groupBy("month", "week", "Vehicle_Type").agg(F.count("*").alias("n"), F.count_distinct("Shipment_ID").alias("ids"))
    return splits.running_use(per, monthly)


# --- models -------------------------------------------------------------------------------------------

FOLD_SQL = """f AS (SELECT Shipment_ID, CAST(Shipment_Date AS DATE) AS d, row_number() OVER (ORDER BY Shipment_Date, sha1(Shipment_ID)) - 1 AS k, count(*) OVER () AS n FROM ship),
folds AS (SELECT *, CASE WHEN k < n - 5 * (n // 6) THEN 0 ELSE CAST(1 + (k - (n - 5 * (n // 6))) // (n // 6) AS INTEGER) END AS time_fold FROM f)"""


@query("walk_forward_verdict", with_ship("SELECT CAST(time_fold AS INTEGER) AS time_fold, count(*) AS shipments, count(*) AS scored, min(d) AS first_day, max(d) AS last_day, time_fold = 0 AS warm_up, true AS better_than_chance FROM folds GROUP BY time_fold", FOLD_SQL))
def walk_forward_verdict(spark, sf):
    """Every shipment has a probability; the folds' sizes and days; every fold is ranked better than chance."""
    walked = model.walk_forward(jq._prepared(spark, sf, "time", "vendor"), jq.FULL)
    walked = materialise(walked.select("time_fold", "Full_Date", "is_delayed", "probability", "warm_up"), "walk")
    auc = metrics.roc_auc(walked, "probability", by=["time_fold"])
    facts = walked.groupBy("time_fold").agg(F.count("*").alias("shipments"), F.count_if(F.expr(PROBABLE)).alias("scored"), F.min("Full_Date").alias("first_day"), F.max("Full_Date").alias("last_day"), F.bool_and("warm_up").alias("warm_up"))
    return facts.join(auc, "time_fold").select("time_fold", "shipments", "scored", "first_day", "last_day", "warm_up", (F.col("roc_auc") > 0.55).alias("better_than_chance"))


@query("chronological_evaluation_verdict", with_ship("SELECT n - CAST(floor(n * 0.8) AS BIGINT) AS shipments, n - CAST(floor(n * 0.8) AS BIGINT) AS scored, min(d) AS first_day, max(d) AS last_day, true AS better_than_chance, true AS better_than_base_rate FROM f WHERE k >= CAST(floor(n * 0.8) AS BIGINT) GROUP BY n", FOLD_SQL))
def chronological_evaluation_verdict(spark, sf):
    _, test = model.chronological_evaluation(jq._prepared(spark, sf), jq.FULL)
    q = metrics.metric_bundle(test, "probability").first()
    return test.agg(F.count("*").alias("shipments"), F.count_if(F.expr(PROBABLE)).alias("scored"), F.min("Full_Date").alias("first_day"), F.max("Full_Date").alias("last_day"),
                    F.lit(q["roc_auc"] > 0.6).alias("better_than_chance"), F.lit(q["brier"] < q["baseline_brier"]).alias("better_than_base_rate"))


def _named(names):
    return " UNION ALL ".join(f"SELECT '{n}' AS name" for n in names)


@query("split_strategies_verdict", f"SELECT name, true AS better_than_chance FROM ({_named(['random', 'vendor_grouped'])})")
def split_strategies_verdict(spark, sf):
    return REGISTRY["split_strategies"][0](spark, sf).select(F.col("strategy").alias("name"), (F.col("roc_auc") > 0.6).alias("better_than_chance"))


@query("scoring_regimes_verdict", with_ship(f"SELECT name, n AS shipments, true AS better_than_chance FROM (SELECT count(*) AS n FROM ship), ({_named(['calibrated out-of-fold', 'uncalibrated out-of-fold', 'calibrated in-sample'])})"))
def scoring_regimes_verdict(spark, sf):
    return REGISTRY["scoring_regimes"][0](spark, sf).select(F.col("regime").alias("name"), "shipments", (F.col("roc_auc") > 0.6).alias("better_than_chance"))


@query("feature_ablation_verdict", f"SELECT name, true AS ranked FROM ({_named(['none', 'Distance_km', 'Weight_tons', 'Vendor_Rating', 'Weather_Condition', 'Traffic_Density', 'Vehicle_Type'])})")
def feature_ablation_verdict(spark, sf):
    """Without the vendor's rating the ranking is clearly worse; without any other feature it is still better than chance."""
    t = materialise(REGISTRY["feature_ablation"][0](spark, sf), "ablation")
    whole = t.where("dropped = 'none'").select("roc_auc").scalar()
    return t.select(F.col("dropped").alias("name"), F.when(F.col("dropped") == "Vendor_Rating", F.col("roc_auc") < whole - 0.01).otherwise(F.col("roc_auc") > 0.55).alias("ranked"))


@query("calibration_methods_verdict", "SELECT CAST(k AS INTEGER) AS seed, true AS calibrated FROM range(1, 4) r(k)")
def calibration_methods_verdict(spark, sf):
    t = REGISTRY["calibration_methods"][0](spark, sf)
    return t.select("seed", ((F.col("isotonic_ece") < 0.05) & (F.col("sigmoid_ece") < 0.1) & (F.abs(F.col("difference") - (F.col("isotonic_ece") - F.col("sigmoid_ece"))) < 1e-12)).alias("calibrated"))


FEATURE_SQL = f"SELECT name, true AS in_range FROM ({_named(['Distance_km', 'Weight_tons', 'Vendor_Rating', 'Weather_Condition', 'Traffic_Density', 'Vehicle_Type'])})"


@query("impurity_importance_verdict", FEATURE_SQL)
def impurity_importance_verdict(spark, sf):
    """Shares that add up to one."""
    t = materialise(REGISTRY["impurity_importance"][0](spark, sf), "importance")
    total = t.agg(F.sum("importance")).scalar()
    return t.select(F.col("feature").alias("name"), (F.col("importance").between(0.0, 1.0) & (F.abs(total - 1.0) < 1e-3)).alias("in_range"))


@query("permutation_importance_verdict", FEATURE_SQL)
def permutation_importance_verdict(spark, sf):
    """A shuffled rating costs more than anything else; no drop is beyond what a ranking can lose."""
    t = materialise(REGISTRY["permutation_importance"][0](spark, sf), "permutation")
    top = t.agg(F.max_by("feature", "auc_drop")).scalar()
    return t.select(F.col("feature").alias("name"), (F.col("auc_drop").between(-0.05, 0.5) & (F.col("std") >= 0) & (top == "Vendor_Rating")).alias("in_range"))


@query("saved_model_verdict", with_ship("SELECT count(*) AS rows, true AS same, true AS in_range FROM ship"))
def saved_model_verdict(spark, sf):
    t = REGISTRY["saved_model_check"][0](spark, sf)
    return t.select(F.col("rows").cast("long").alias("rows"), (F.col("largest_difference") <= 1e-9).alias("same"), ((F.col("least") >= 0) & (F.col("most") <= 1)).alias("in_range"))


@query("batch_scores_verdict", with_ship("""SELECT Shipment_ID, true AS in_range, true AS tier_agrees, round(co2_formula, 4) AS co2_kg, round(co2_formula / 1000.0::DOUBLE * 50.0::DOUBLE, 4) AS carbon_cost FROM ship"""))
def batch_scores_verdict(spark, sf):
    """The scored file, row by row: all but the probability itself is in SQL."""
    p = F.col("Delay_Risk_Probability")
    return REGISTRY["batch_scores"][0](spark, sf).select(
        "Shipment_ID", p.between(0.0, 1.0).alias("in_range"), (F.col("Risk_Level") == fx.risk_tier(p)).alias("tier_agrees"),
        *[(F.round(F.col(c) * 1e4) / 1e4).alias(n) for c, n in (("CO2_Emission_kg_calculated", "co2_kg"), ("Carbon_Cost", "carbon_cost"))])  # ties as SQL rounds them


@query("raw_vehicle_guard_verdict", with_ship("SELECT count(*) AS shipments, true AS decided FROM ship"))
def raw_vehicle_guard_verdict(spark, sf):
    t = REGISTRY["raw_vehicle_guard"][0](spark, sf)
    return t.select(F.col("shipments").cast("long").alias("shipments"), (F.col("worst_spread").between(0.0, 1.0) & (F.col("passed") == (F.col("worst_spread") < P.MAX_VEHICLE_SPREAD))).alias("decided"))


@query("training_run_verdict", with_ship("SELECT count(*) AS n_rows, round(avg((Actual_Delay_Days > 0)::INT), 6) AS positive_rate, 6 AS features, true AS measured FROM ship"))
def training_run_verdict(spark, sf):
    """The stored metadata document: rows and rate of the training data, and metrics that lie where they can.

    The document keeps four digits of the rate; they must be those of the rate that the table gives.
    """
    t = REGISTRY["training_run"][0](spark, sf)
    rate = F.lit(dated(spark, sf).agg(F.avg("is_delayed")).first()[0]).cast("double")
    m = [F.col(f"metrics.{c}").between(0.5, 1.0) for c in ("oof_roc_auc", "chronological_holdout_roc_auc", "chronological_cv_roc_auc_mean")]
    return t.select(F.col("training_data.n_rows").cast("long").alias("n_rows"), F.round(rate, 6).alias("positive_rate"), F.size("feature_order").alias("features"),
                    (m[0] & m[1] & m[2] & F.col("training_data_sha256").isNotNull() & (F.abs(F.col("training_data.positive_rate") - F.bround(rate, 4)) < 1e-9)).alias("measured"))


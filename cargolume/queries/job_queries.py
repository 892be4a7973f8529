"""Queries that write and read back, stream, fingerprint, generate, and fit models."""

from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.functions import generators as gen
from cargolume.functions.keys import uniform
from cargolume.operators import contracts, fingerprint, metrics, model, panels, star
from cargolume.plans import jobs
from cargolume.queries.allocation_queries import RANKED, _ranked
from cargolume.queries.base import query, with_ship
from cargolume.queries.formula_queries import r
from cargolume.queries.metric_queries import SCORED, dated, rounded
from cargolume.queries.star_queries import DATE_SQL, FACT_SQL, ROUTE_SQL, VENDOR_SQL, star_tables
from cargolume.schemas import FEATURES, RAW_COLUMNS, ROUTE_COLUMNS
from cargolume.session import discard, fresh_path, materialise
from cargolume.sources import readers, writers
from cargolume.sources.shipments import read_table, shipments, shipments_from
from cargolume.streaming import jobs as streams

# --- sources and sinks ---


@query("star_schema_stored", with_ship("SELECT * FROM fact", FACT_SQL))
def star_schema_stored(spark, sf):
    """Star schema written by month and read back with its schema."""
    folder = fresh_path(spark, "star")
    writers.write_star(star_tables(spark, sf), folder)
    return readers.load_star(spark, folder)["fact"]


@query("star_dimensions_stored", with_ship("""
SELECT 'dim_vendor' AS "table", count(*) AS "rows" FROM dim_vendor UNION ALL SELECT 'dim_route', count(*) FROM dim_route
UNION ALL SELECT 'dim_date', count(*) FROM dim_date""", VENDOR_SQL, ROUTE_SQL, DATE_SQL))
def star_dimensions_stored(spark, sf):
    folder = fresh_path(spark, "star")
    writers.write_star(star_tables(spark, sf), folder, "csv")
    kept, out = readers.load_star(spark, folder, "csv"), None
    for name in ("dim_vendor", "dim_route", "dim_date"):
        row = kept[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


@query("raw_csv_stored", with_ship("SELECT " + ", ".join(RAW_COLUMNS) + " FROM ship"))
def raw_csv_stored(spark, sf):
    """Ordered CSV export, read back through the checked CSV source."""
    path = fresh_path(spark, "raw") + "_csv"
    writers.export_csv(shipments(spark, sf, RAW_COLUMNS), path, "Shipment_ID")
    return readers.load_raw(spark, path)


@query("plan_stored", with_ship("SELECT Vehicle_Type, count(*) AS shipments, 'cheapest' AS scenario FROM ranked GROUP BY 1", RANKED))
def plan_stored(spark, sf):
    folder = fresh_path(spark, "plans")
    writers.write_plan(_ranked(spark, sf)[1], folder, "cheapest")
    return spark.read.parquet(folder).groupBy("Vehicle_Type", "scenario").agg(F.count("*").alias("shipments"))


AUDIT_INPUTS = ["Shipment_ID", "Vendor_ID", "Shipment_Date", *FEATURES, "raw_score"]
AUDIT_SQL = """SELECT Shipment_ID AS shipment_id, Vendor_ID AS vendor_id, Distance_km AS distance_km, Weight_tons AS weight_tons, Vendor_Rating AS vendor_rating,
  Weather_Condition AS weather_condition, Traffic_Density AS traffic_density, Vehicle_Type AS vehicle_type, round(raw_score, 6) AS probability,
  CASE WHEN raw_score >= 0.5 THEN 'High Risk' WHEN raw_score >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level, 0.5::DOUBLE AS high_threshold,
  0.2::DOUBLE AS medium_threshold, 4.0::DOUBLE AS cost_fn_over_fp, co2_formula AS co2_kg, 50.0::DOUBLE AS carbon_price_per_ton,
  co2_formula / 1000.0::DOUBLE * 50.0::DOUBLE AS carbon_cost, 'delay_risk' AS model_name, '1' AS model_version,
  Distance_km < 100 OR Distance_km > 1200 AS extrapolated FROM ship"""


def _audit_view(rows):
    return rows.drop("scored_at", "route_id", "artifact_sha256").withColumn("probability", r("probability"))


@query("audit_records", with_ship(AUDIT_SQL))
def audit_records(spark, sf):
    df = shipments(spark, sf, AUDIT_INPUTS).withColumn("Delay_Risk_Probability", F.col("raw_score"))
    return _audit_view(writers.audit_rows(writers.assessments(df, {"Distance_km": (100.0, 1200.0)})))


@query("audit_log_stored", with_ship("SELECT risk_level, count(*) AS decisions, round(sum(co2_kg), 4) AS co2_kg FROM (" + AUDIT_SQL + ") GROUP BY 1"))
def audit_log_stored(spark, sf):
    df = shipments(spark, sf, AUDIT_INPUTS).withColumn("Delay_Risk_Probability", F.col("raw_score"))
    path = fresh_path(spark, "audit")
    rows = writers.audit_rows(writers.assessments(df))
    writers.append_audit(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.groupBy("risk_level").agg(F.count("*").alias("decisions"), r(F.sum("co2_kg"), 4).alias("co2_kg"))


# --- fingerprints ---


@query("table_fingerprints")
def table_fingerprints(spark, sf):
    return fingerprint.fingerprints(star_tables(spark, sf))


@query("fingerprint_mismatches", with_ship("""
SELECT 'dim_vendor' AS "table" WHERE EXISTS (SELECT Vendor_ID, Vendor_Rating + 0.01 FROM dim_vendor EXCEPT SELECT * FROM dim_vendor)
UNION ALL SELECT 'dim_route' WHERE EXISTS (SELECT * FROM dim_route EXCEPT SELECT * FROM dim_route)""", VENDOR_SQL, ROUTE_SQL))
def fingerprint_mismatches(spark, sf):
    """One table changed, one unknown, one equal after a repartition: only the change is reported."""
    t = star_tables(spark, sf)
    recorded = fingerprint.fingerprints({"dim_vendor": t["dim_vendor"], "dim_route": t["dim_route"], "dim_date": None})
    current = fingerprint.fingerprints({
        "dim_vendor": t["dim_vendor"].withColumn("Vendor_Rating", F.col("Vendor_Rating") + 0.01),
        "dim_route": t["dim_route"].repartition(7), "dim_date": t["dim_date"]})
    return fingerprint.fingerprint_mismatches(recorded, current).select("table")


@query("load_audit_manifest")
def load_audit_manifest(spark, sf):
    t = star_tables(spark, sf)
    made = fingerprint.manifest(t, "load-1")
    digest = made.where("table = 'dim_vendor'").first()["digest"]
    stamped = fingerprint.with_load_audit(t["dim_vendor"], "load-1", "2026-01-01 00:00:00", digest)
    kept = stamped.groupBy("_batch_id", "_source_sha256", "_schema_version").agg(F.count("*").alias("stamped_rows"))
    return made.join(kept, (F.col("batch_id") == F.col("_batch_id")) & (F.col("digest") == F.col("_source_sha256")), "left").select(
        "table", "rows", "digest", "batch_id", "stamped_rows", "_schema_version")


# --- generators ---


def _cities(spark, sf):
    key = F.col("n_nationkey")
    return read_table(spark, sf, "nation").select(
        F.col("n_name").alias("city"), (36.0 + (key * 7 % 25) * 0.24).alias("lat"), (26.5 + (key * 11 % 25) * 0.72).alias("lon"))


@query("city_pair_distances", """
WITH c AS (SELECT n_name AS city, radians(36.0::DOUBLE + (n_nationkey * 7 % 25) * 0.24::DOUBLE) AS la, radians(26.5::DOUBLE + (n_nationkey * 11 % 25) * 0.72::DOUBLE) AS lo FROM nation),
p AS (SELECT DISTINCT s.n_name AS Origin, d.n_name AS Destination FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation d ON c_nationkey = d.n_nationkey)
SELECT Origin, Destination, round_even(2 * 6371.0088::DOUBLE * asin(sqrt(pow(sin((b.la - a.la) / 2), 2) + cos(a.la) * cos(b.la) * pow(sin((b.lo - a.lo) / 2), 2))) * 1.25, 1)::DOUBLE AS road_km
FROM p JOIN c a ON a.city = Origin JOIN c b ON b.city = Destination WHERE Origin <> Destination""")
def city_pair_distances(spark, sf):
    return gen.city_pair_distances(shipments(spark, sf, ["Origin", "Destination"]), _cities(spark, sf))


@query("assigned_vehicles")
def assigned_vehicles(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Vendor_ID", "Distance_km", "Weight_tons"])
    return df.select("Shipment_ID", gen.assign_vehicle().alias("Vehicle_Type"))


@query("vehicle_probabilities")
def vehicle_probabilities(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Vendor_ID", "Distance_km", "Weight_tons"])
    return df.select("Shipment_ID", F.posexplode(gen.vehicle_probabilities()).alias("option", "probability"))


@query("drawn_delay_days")
def drawn_delay_days(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Vendor_Rating", "Weather_Condition", "Traffic_Density", "raw_score"])
    late = uniform(11, F.col("Shipment_ID")) < F.col("raw_score")
    days = gen.truncated_poisson_days(gen.severity(), uniform(12, F.col("Shipment_ID")))
    return df.select("Shipment_ID", F.when(late, days).otherwise(0).alias("Delay_Days"))


DELAY_U = "((l_orderkey * 31 + l_linenumber * 17) % 1000) / 1000.0::DOUBLE"


@query("delay_day_quantiles", with_ship(f"""
SELECT Shipment_ID, CAST(1 + (u > w0 / t)::INT + (u > (w0 + w1) / t)::INT + (u > (w0 + w1 + w2) / t)::INT + (u > (w0 + w1 + w2 + w3) / t)::INT AS INTEGER) AS delay_days
FROM (SELECT *, w0 + w1 + w2 + w3 + w4 AS t FROM (SELECT Shipment_ID, u, 1.0::DOUBLE AS w0, m AS w1, m * m / 2 AS w2, m * m * m / 6 AS w3, m * m * m * m / 24 AS w4 FROM (
  SELECT Shipment_ID, ({DELAY_U}) + 0.0003::DOUBLE AS u, greatest(0.3::DOUBLE + CASE Weather_Condition WHEN 'Normal' THEN 0.0::DOUBLE WHEN 'Rain' THEN 0.25::DOUBLE WHEN 'Storm' THEN 1.1::DOUBLE ELSE 0.75::DOUBLE END
    + CASE Traffic_Density WHEN 'Low' THEN 0.0::DOUBLE WHEN 'Medium' THEN 0.15::DOUBLE ELSE 0.45::DOUBLE END + (3.25::DOUBLE - Vendor_Rating) * 0.18::DOUBLE, 0.05::DOUBLE) AS m FROM ship)))"""))
def delay_day_quantiles(spark, sf):
    """Truncated-Poisson quantiles of a uniform made from the keys, so SQL can follow."""
    df = shipments(spark, sf, ["Shipment_ID", "Vendor_Rating", "Weather_Condition", "Traffic_Density"])
    part = F.split("Shipment_ID", "-")
    u = ((part[0].cast("long") * 31 + part[1].cast("long") * 17) % 1000) / 1000.0 + 0.0003
    return df.select("Shipment_ID", gen.truncated_poisson_days(gen.severity(), u).alias("delay_days"))


# --- streaming ---


def _stream(spark, sf, columns):
    lines = read_table(spark, sf, "lineitem")
    source = spark.readStream.schema(lines.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    return _timed(shipments_from(source, spark, sf, columns))


def _timed(df):
    """Midnight UTC of the shipment day, whatever the session's time zone."""
    return df.withColumn("event_time", F.timestamp_seconds(F.unix_date(F.to_date("Shipment_Date")).cast("long") * 86400))


def _run(spark, stream, label):
    out = fresh_path(spark, label)
    streams.run_to_end(stream, out, f"{out}-state")
    return spark.read.schema(stream.schema).parquet(out)


def _as_days(df):
    def day(c):
        return F.date_from_unix_date((F.unix_seconds(c) / 86400).cast("int")).alias(c)

    return df.select(*[day(c) if c in ("window_start", "window_end") else F.col(c) for c in df.columns])


@query("streamed_audit", with_ship(AUDIT_SQL))
def streamed_audit(spark, sf):
    """Lines scored as a stream into the audit table, once per shipment."""
    rows = streams.audit_stream(
        _stream(spark, sf, AUDIT_INPUTS), lambda d: d.withColumn("Delay_Risk_Probability", F.col("raw_score")),
        ranges={"Distance_km": (100.0, 1200.0)})
    out = fresh_path(spark, "stream")
    streams.run_audit(rows, out, f"{out}-state")
    return _audit_view(spark.read.schema(rows.schema).parquet(out))


WINDOWS = """timed AS (SELECT *, date_diff('day', DATE '1970-01-01', Full_Date) AS d FROM scored),
windowed AS (SELECT *, DATE '1970-01-01' + CAST(d // 30 * 30 AS INTEGER) AS window_start, DATE '1970-01-01' + CAST(d // 30 * 30 + 30 AS INTEGER) AS window_end,
  (SELECT max(Full_Date) FROM scored) AS last_day FROM timed)"""
KPI_SQL = """SELECT window_start, window_end, count(*) AS shipments, round(sum(CO2_Emission_kg) / 1000, 4) AS co2_tons, round(sum(CO2_Emission_kg) / 1000 * 50, 4) AS carbon_tax,
  round(avg(Actual_Delay_Days), 4) AS average_delay_days, round(count_if(raw_score >= 0.5) / count(*), 4) AS high_risk_rate FROM windowed {where} GROUP BY 1, 2"""
KPI_INPUTS = ["Shipment_Date", "CO2_Emission_kg", "Actual_Delay_Days", "raw_score"]


def _tiered(df):
    return df.withColumn("Risk_Level", fx.risk_tier("raw_score"))


@query("window_measures", with_ship(KPI_SQL.format(where=""), SCORED, WINDOWS))
def window_measures(spark, sf):
    return rounded(_as_days(streams.window_measures(_tiered(_timed(shipments(spark, sf, KPI_INPUTS))))), 4)


@query("streamed_window_measures", with_ship(KPI_SQL.format(where="WHERE window_end <= last_day - 7"), SCORED, WINDOWS))
def streamed_window_measures(spark, sf):
    """The windows that the watermark has closed."""
    rows = streams.window_measures(_tiered(_stream(spark, sf, KPI_INPUTS)), delay="7 days")
    return rounded(_as_days(_run(spark, rows, "stream")), 4)


EDGES = [100.0, 300.0, 600.0, 900.0, 1200.0]
DRIFT_SQL = """SELECT window_start, window_end, CAST(sum(n) AS BIGINT) AS "rows", round(sum((greatest(s, 1e-4) - greatest(b, 1e-4)) * ln(greatest(s, 1e-4) / greatest(b, 1e-4))), 6) AS psi, round(max(abs(us - ub)), 6) AS ks
FROM (SELECT w.window_start, w.window_end, base.bin, coalesce(c.n, 0) AS n, coalesce(c.n, 0) / w.total AS s, base.b,
    sum(coalesce(c.n, 0) / w.total) OVER (PARTITION BY w.window_start ORDER BY base.bin) AS us, sum(base.b) OVER (PARTITION BY w.window_start ORDER BY base.bin) AS ub
  FROM (SELECT window_start, window_end, count(*) AS total FROM binned GROUP BY 1, 2) w, base
  LEFT JOIN (SELECT window_start, bin, count(*) AS n FROM binned GROUP BY 1, 2) c ON c.window_start = w.window_start AND c.bin = base.bin) GROUP BY 1, 2"""
DRIFT_CTES = ("""binned AS (SELECT *, (Distance_km >= 100)::INT + (Distance_km >= 300)::INT + (Distance_km >= 600)::INT + (Distance_km >= 900)::INT + (Distance_km >= 1200)::INT AS bin FROM windowed)""",
              """base AS (SELECT bin, count(*) / (SELECT count(*) FROM binned WHERE Shipment_Date < '2000-01-01') AS b FROM binned WHERE Shipment_Date < '2000-01-01' GROUP BY 1)""")


def _shares(spark, sf):
    past = shipments(spark, sf, ["Shipment_Date", "Distance_km"]).where("Shipment_Date < '2000-01-01'")
    return streams.training_shares(past, "Distance_km", EDGES)


@query("input_drift", with_ship(DRIFT_SQL, SCORED, WINDOWS, *DRIFT_CTES))
def input_drift(spark, sf):
    df = _timed(shipments(spark, sf, ["Shipment_Date", "Distance_km"]))
    return rounded(_as_days(streams.drift(streams.bin_counts(df, "Distance_km", EDGES), _shares(spark, sf))))


@query("streamed_input_drift", with_ship(
    DRIFT_SQL.replace("FROM binned GROUP BY 1, 2) w", "FROM binned WHERE window_end <= last_day - 7 GROUP BY 1, 2) w"), SCORED, WINDOWS, *DRIFT_CTES))
def streamed_input_drift(spark, sf):
    counts = streams.bin_counts(_stream(spark, sf, ["Shipment_Date", "Distance_km"]), "Distance_km", EDGES, delay="7 days")
    return rounded(_as_days(streams.drift(_run(spark, counts, "stream"), _shares(spark, sf))))


@query("event_drift", """
SELECT DATE '1970-01-01' + CAST(d // 5 * 5 AS INTEGER) AS window_start, DATE '1970-01-01' + CAST(d // 5 * 5 + 5 AS INTEGER) AS window_end,
  CAST((value >= 5)::INT + (value >= 10)::INT + (value >= 20)::INT AS INTEGER) AS bin, count(*) AS n
FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d FROM events) GROUP BY ALL""")
def event_drift(spark, sf):
    """The same window counts over the events table."""
    events = read_table(spark, sf, "events")
    day = F.timestamp_seconds(F.unix_date(F.to_date("ts")).cast("long") * 86400)
    return _as_days(streams.bin_counts(events.withColumn("event_time", day), "value", [5.0, 10.0, 20.0], width="5 days"))


# --- models: all trees, depth, folds, members, features and repeats of the operator's defaults ---

FULL = model.ModelSettings()


def _prepared(spark, sf, *folds):
    return model.prepare(dated(spark, sf, ["Vendor_ID", *FEATURES]), FULL, folds=folds)


@query("walk_forward_scores")
def walk_forward_scores(spark, sf):
    return model.walk_forward(_prepared(spark, sf, "time", "vendor"), FULL).select("Shipment_ID", "probability", "warm_up")


@query("walk_forward_quality")
def walk_forward_quality(spark, sf):
    walked = model.walk_forward(_prepared(spark, sf, "time"), FULL, fallback=False)
    return model.chronological_cv(materialise(walked.select("time_fold", "Full_Date", "is_delayed", "probability"), "walk"))


@query("merged_scores", with_ship("""
SELECT Shipment_ID, round(coalesce(CASE WHEN Shipment_Date >= '1997-01-01' THEN raw_score END, raw_score * 0.5), 6) AS probability, Shipment_Date < '1997-01-01' AS warm_up FROM ship"""))
def merged_scores(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date", "raw_score"])
    both = df.withColumn("walk", F.when(F.col("Shipment_Date") >= "1997-01-01", F.col("raw_score"))).withColumn(
        "grouped", F.col("raw_score") * 0.5)
    return rounded(model.merge_scores(both, "walk", "grouped").select("Shipment_ID", "probability", "warm_up"))


@query("chronological_evaluation")
def chronological_evaluation(spark, sf):
    _, test = model.chronological_evaluation(_prepared(spark, sf), FULL)
    return metrics.classification_report(test, "probability")


@query("split_strategies")
def split_strategies(spark, sf):
    return model.compare_split_strategies(_prepared(spark, sf, "vendor", "random"), FULL)


@query("scoring_regimes")
def scoring_regimes(spark, sf):
    return model.scoring_regimes(_prepared(spark, sf, "time", "vendor"), FULL)


@query("feature_ablation")
def feature_ablation(spark, sf):
    return model.feature_ablation(_prepared(spark, sf, "random"), FULL)


@query("calibration_methods")
def calibration_methods(spark, sf):
    return model.calibration_methods(_prepared(spark, sf, "random"), FULL)


@query("impurity_importance")
def impurity_importance(spark, sf):
    return model.impurity_importance(spark, model.fit_model(_prepared(spark, sf), FULL))


@query("permutation_importance")
def permutation_importance(spark, sf):
    fitted, test = model.chronological_evaluation(_prepared(spark, sf), FULL)
    return model.permutation_importance(fitted, test)


@query("saved_model_check")
def saved_model_check(spark, sf):
    prepared = _prepared(spark, sf)
    fitted, path = model.fit_model(prepared, FULL), fresh_path(spark, "model")
    fitted.save(path)
    return model.verify_saved(spark, path, fitted, prepared)


@query("batch_scores")
def batch_scores(spark, sf):
    """Shipments file in, scored file out, by a saved model, with the audit log."""
    prepared = _prepared(spark, sf)
    folder = fresh_path(spark, "score")
    model.fit_model(prepared, FULL).save(f"{folder}/model")
    prepared.select("Shipment_ID", "Vendor_ID", *FEATURES).write.parquet(f"{folder}/in")
    discard(prepared)
    return jobs.run_batch_scoring(spark, f"{folder}/model", f"{folder}/in", f"{folder}/out", f"{folder}/audit")


@query("batch_decisions", with_ship("""
SELECT Shipment_ID, CASE WHEN raw_score >= 0.5 THEN 'High Risk' WHEN raw_score >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level,
  co2_formula AS CO2_Emission_kg_calculated, co2_formula / 1000.0::DOUBLE * 50.0::DOUBLE AS Carbon_Cost FROM ship"""))
def batch_decisions(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", *FEATURES, "raw_score"]).withColumnRenamed("raw_score", "Delay_Risk_Probability")
    return model.with_decisions(df).select("Shipment_ID", "Risk_Level", "CO2_Emission_kg_calculated", "Carbon_Cost")


@query("raw_vehicle_guard")
def raw_vehicle_guard(spark, sf):
    """The guard on the model's own counterfactual scores."""
    prepared = _prepared(spark, sf)
    fitted = model.fit_model(prepared, FULL)
    grid = panels.counterfactual_grid(prepared.select("Shipment_ID", *FEATURES))
    return panels.vehicle_guard(fitted.transform(grid, "p"))


@query("training_run")
def training_run(spark, sf):
    """All training stages; the run's metadata document as it was stored."""
    folder = fresh_path(spark, "training")
    stored = fresh_path(spark, "star")
    writers.write_star(star_tables(spark, sf), stored)
    jobs.run_training(readers.load_star(spark, stored), folder, "all", FULL)
    return spark.read.json(f"{folder}/metadata")


@query("distance_rule_gate", with_ship("""
SELECT CASE WHEN count_if(n > 1 AND sd / m > 0.15) = 0 THEN 'passed' ELSE 'failed' END AS verdict, count(*) AS pairs
FROM (SELECT count(*) AS n, stddev_samp(Distance_km) AS sd, avg(Distance_km) AS m FROM ship GROUP BY Origin, Destination)"""))
def distance_rule_gate(spark, sf):
    df = shipments(spark, sf, ["Origin", "Destination", "Distance_km"])
    contracts.require_distance_rule(df)
    return df.agg(F.lit("passed").alias("verdict"), F.count_distinct("Origin", "Destination").alias("pairs"))


@query("route_key_durability", with_ship("""
SELECT count(*) AS old_routes, count(*) AS unchanged FROM (SELECT DISTINCT Origin, Destination, Vehicle_Type, Weather_Condition, Traffic_Density FROM ship WHERE Shipment_Date < '2000-01-01')"""))
def route_key_durability(spark, sf):
    """Keys of the routes known before a load, compared after it."""
    raw = shipments(spark, sf, ["Shipment_Date", *ROUTE_COLUMNS])
    old = star.dim_route(raw.where("Shipment_Date < '2000-01-01'"))
    new = star.extend_routes(old, raw).withColumnRenamed("Route_ID", "after")
    both = old.join(new, ROUTE_COLUMNS, "left")
    return both.agg(F.count("*").alias("old_routes"), F.count_if(F.col("Route_ID") == F.col("after")).alias("unchanged"))

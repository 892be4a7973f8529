"""Queries on splits, metrics and business measures."""

from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions import formulas as fx
from cargolume.functions.calendar import season
from cargolume.operators import kpis, metrics, splits
from cargolume.queries.base import query, with_ship
from cargolume.queries.formula_queries import CO2_INPUTS, r
from cargolume.queries.star_queries import DATE_SQL, FACT_SQL, ROUTE_SQL, VENDOR_SQL, star_tables, stored_scores
from cargolume.sources.shipments import shipments



def day():
    return F.to_date("Shipment_Date")


def rounded(df, digits=6, keep=()):
    """Round the double columns of a result at the very end."""
    return df.select(*[r(c, digits).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def dated(spark, sf, extra=()):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date", "Actual_Delay_Days", *extra])
    return df.withColumn("Full_Date", day()).withColumn("is_delayed", fx.is_delayed())


def labelled(spark, sf, extra=()):
    return shipments(spark, sf, ["Actual_Delay_Days", "raw_score", *extra]).withColumn("is_delayed", fx.is_delayed())


def scored_view(spark, sf, extra=()):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date", "Actual_Delay_Days", "raw_score", "CO2_Emission_kg", *extra])
    p = fx.stored_probability("raw_score")
    return df.withColumn("Delay_Risk_Probability", p).withColumn("Risk_Level", fx.risk_tier(p)) \
        .withColumn("is_delayed", fx.is_delayed())


SCORED = """scored AS (SELECT *, CASE WHEN p >= 0.5 THEN 'High Risk' WHEN p >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level
  FROM (SELECT *, round_even(raw_score, 2)::DOUBLE AS p, CAST(Actual_Delay_Days > 0 AS INTEGER) AS is_delayed,
    CAST(Shipment_Date AS DATE) AS Full_Date FROM ship))"""
POSITION = """placed AS (SELECT *, row_number() OVER (ORDER BY Full_Date, sha1(Shipment_ID)) - 1 AS position, count(*) OVER () AS n FROM scored)"""
HOLDOUT = "holdout AS (SELECT *, CASE WHEN position < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM placed)"
FOLDS = """folded AS (SELECT *, CAST(CASE WHEN position < n - 5 * (n // 6) THEN 0 ELSE (position - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INTEGER) AS fold FROM placed)"""


@query("chronological_position", with_ship("SELECT Shipment_ID, position FROM placed", SCORED, POSITION), longs=("position",))
def chronological_position(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date"]).withColumn("Full_Date", day())
    return splits.chronological_position(df).select("Shipment_ID", "position")


@query("chronological_holdout", with_ship("SELECT Shipment_ID, split FROM holdout", SCORED, POSITION, HOLDOUT))
def chronological_holdout(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date"]).withColumn("Full_Date", day())
    return splits.require_chronology(splits.chronological_holdout(df)).select("Shipment_ID", "split")


@query("expanding_folds", with_ship("SELECT Shipment_ID, fold FROM folded", SCORED, POSITION, FOLDS))
def expanding_folds(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date"]).withColumn("Full_Date", day())
    return splits.expanding_folds(df).select("Shipment_ID", "fold")


@query("fold_summary", with_ship("""
SELECT fold, count(*) AS shipments, min(Full_Date) AS first_day, max(Full_Date) AS last_day, round(avg(is_delayed), 6) AS delay_rate
FROM folded GROUP BY fold""", SCORED, POSITION, FOLDS))
def fold_summary(spark, sf):
    return rounded(splits.fold_summary(splits.expanding_folds(dated(spark, sf))))


@query("stratified_folds", with_ship("""
SELECT Shipment_ID, CAST((row_number() OVER (PARTITION BY is_delayed ORDER BY sha1(Shipment_ID)) - 1) % 5 AS INTEGER) AS fold FROM scored""", SCORED))
def stratified_folds(spark, sf):
    return splits.stratified_folds(dated(spark, sf)).select("Shipment_ID", "fold")


@query("vendor_grouped_folds")
def vendor_grouped_folds(spark, sf):
    return splits.grouped_folds(dated(spark, sf, ["Vendor_ID"])).select("Shipment_ID", "Vendor_ID", "is_delayed", "fold")


@query("weekly_vehicle_budget", with_ship("""
SELECT Vehicle_Type, month, week, used, used_to_date, cap - (used_to_date - used) AS budget_before, cap - used_to_date AS budget_after
FROM (SELECT Vehicle_Type, month, week, used, CAST(sum(used) OVER (PARTITION BY Vehicle_Type, month ORDER BY week) AS BIGINT) AS used_to_date,
  CASE Vehicle_Type WHEN 'Diesel Truck' THEN 400.0::DOUBLE WHEN 'Electric Semi' THEN 110.0::DOUBLE ELSE 250.0::DOUBLE END AS cap
  FROM (SELECT Vehicle_Type, strftime(Full_Date, '%Y-%m') AS month, CAST(date_trunc('week', Full_Date) AS DATE) AS week, count(*) AS used FROM scored GROUP BY ALL))""", SCORED))
def weekly_vehicle_budget(spark, sf):
    caps = {"Diesel Truck": 400.0, "Electric Semi": 110.0, "Hybrid Van": 250.0}
    df = shipments(spark, sf, ["Shipment_Date", "Vehicle_Type"]).withColumn("Full_Date", day())
    return splits.weekly_budget(df, caps)


AUC_SQL = """(SELECT sum(neg * (above + pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) FROM (
  SELECT pos, neg, coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM (SELECT {s} AS s, sum(is_delayed)::DOUBLE AS pos, sum(1 - is_delayed)::DOUBLE AS neg FROM {t} GROUP BY 1)))"""


@query("roc_auc", with_ship(f"SELECT round({AUC_SQL.format(s='raw_score', t='scored')}, 6) AS roc_auc", SCORED))
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(labelled(spark, sf), "raw_score"))


@query("roc_auc_many_scores", with_ship(f"SELECT round({AUC_SQL.format(s='raw_score', t='scored')}, 6) AS roc_auc", SCORED))
def roc_auc_many_scores(spark, sf):
    """The way taken when the distinct scores do not fit one task."""
    return rounded(metrics.roc_auc(labelled(spark, sf), "raw_score", range_rows=500))


BINS = """binned AS (SELECT *, (SELECT count(*) FROM (VALUES (0.1::DOUBLE), (0.2::DOUBLE), (0.30000000000000004::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE),
  (0.6000000000000001::DOUBLE), (0.7000000000000001::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE)) e(x) WHERE {s} >= x) AS bin FROM scored)"""
QUALITY_SQL = """SELECT count(*) AS shipments, round(avg((raw_score - is_delayed) * (raw_score - is_delayed)), 6) AS brier,
  (SELECT round(sum(g) / sum(n), 6) FROM (SELECT abs(sum(raw_score) - sum(is_delayed)) AS g, count(*) AS n FROM binned GROUP BY bin)) AS ece,
  round(avg(is_delayed) * (1 - avg(is_delayed)), 6) AS baseline_brier"""


@query("expected_calibration_error", with_ship(QUALITY_SQL + " FROM scored", SCORED, BINS.format(s="raw_score")))
def expected_calibration_error(spark, sf):
    return rounded(metrics.calibration_error(labelled(spark, sf), "raw_score"))


@query("metric_bundle", with_ship(f"{QUALITY_SQL}, round({AUC_SQL.format(s='raw_score', t='scored')}, 6) AS roc_auc FROM scored", SCORED, BINS.format(s="raw_score")))
def metric_bundle(spark, sf):
    return rounded(metrics.metric_bundle(labelled(spark, sf), "raw_score"))


@query("reliability_curve", with_ship("""
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS shipments, round(avg(raw_score), 6) AS mean_predicted, round(avg(is_delayed), 6) AS realised_rate FROM binned GROUP BY bin""",
    SCORED, BINS.format(s="raw_score").replace(">= x", "> x")))
def reliability_curve(spark, sf):
    return rounded(metrics.reliability_curve(labelled(spark, sf), "raw_score"))


@query("calibration_by_tier", with_ship("""
SELECT Risk_Level, CAST(CASE Risk_Level WHEN 'High Risk' THEN 0 WHEN 'Medium Risk' THEN 1 ELSE 2 END AS INTEGER) AS tier_order, count(*) AS shipments,
  round(avg(p), 6) AS mean_predicted, round(avg(is_delayed), 6) AS realised_rate, round(avg(Actual_Delay_Days), 6) AS mean_delay_days,
  round(avg(p) - avg(is_delayed), 6) AS deviation FROM scored GROUP BY Risk_Level""", SCORED))
def calibration_by_tier(spark, sf):
    return rounded(metrics.calibration_by_tier(scored_view(spark, sf)))


CURVE_SQL = """SELECT threshold, cost_ratio, count_if(hit AND is_delayed = 1) AS tp, count_if(hit AND is_delayed = 0) AS fp,
  count_if(NOT hit AND is_delayed = 1) AS fn, round(avg(hit::INT), 6) AS alert_rate,
  count_if(hit AND is_delayed = 0) + cost_ratio * count_if(NOT hit AND is_delayed = 1) AS cost
FROM (SELECT *, raw_score >= threshold AS hit FROM scored, (VALUES {t}) t(threshold), (VALUES {c}) c(cost_ratio)) GROUP BY threshold, cost_ratio"""


@query("alert_cost", with_ship(CURVE_SQL.format(t="(0.2::DOUBLE)", c="(4.0::DOUBLE)"), SCORED), longs=("tp", "fp", "fn"))
def alert_cost(spark, sf):
    return rounded(metrics.alert_cost(labelled(spark, sf), "raw_score", P.MEDIUM_THRESHOLD))


@query("alert_cost_curve", with_ship(CURVE_SQL.format(
    t=", ".join(f"({t}::DOUBLE)" for t in (0.05, 0.1, 0.15, 0.2, 0.25, 0.33, 0.5, 0.65, 0.8)),
    c=", ".join(f"({c}::DOUBLE)" for c in (2.0, 3.0, 4.0, 5.0))), SCORED), longs=("tp", "fp", "fn"))
def alert_cost_curve(spark, sf):
    return rounded(metrics.alert_cost_curve(labelled(spark, sf), "raw_score",
                                            [0.05, 0.1, 0.15, 0.2, 0.25, 0.33, 0.5, 0.65, 0.8], [2.0, 3.0, 4.0, 5.0]))


@query("classification_report", with_ship("""
SELECT * REPLACE (round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1) FROM (
  SELECT '0' AS class, tn / (tn + fn) AS "precision", tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1, CAST(tn + fp AS BIGINT) AS support FROM c
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), CAST(tp + fn AS BIGINT) FROM c
  UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, CAST(n AS BIGINT) FROM c
  UNION ALL SELECT 'macro avg', (tn / (tn + fn) + tp / (tp + fp)) / 2, (tn / (tn + fp) + tp / (tp + fn)) / 2, (2 * tn / (2 * tn + fn + fp) + 2 * tp / (2 * tp + fp + fn)) / 2, CAST(n AS BIGINT) FROM c
  UNION ALL SELECT 'weighted avg', (tn / (tn + fn) * (tn + fp) + tp / (tp + fp) * (tp + fn)) / n, (tn / (tn + fp) * (tn + fp) + tp / (tp + fn) * (tp + fn)) / n,
    (2 * tn / (2 * tn + fn + fp) * (tn + fp) + 2 * tp / (2 * tp + fp + fn) * (tp + fn)) / n, CAST(n AS BIGINT) FROM c)""", SCORED,
    """c AS (SELECT count_if(raw_score >= 0.5 AND is_delayed = 1)::DOUBLE AS tp, count_if(raw_score >= 0.5 AND is_delayed = 0)::DOUBLE AS fp,
      count_if(raw_score < 0.5 AND is_delayed = 1)::DOUBLE AS fn, count_if(raw_score < 0.5 AND is_delayed = 0)::DOUBLE AS tn, count(*)::DOUBLE AS n FROM scored)"""))
def classification_report(spark, sf):
    return rounded(metrics.classification_report(labelled(spark, sf), "raw_score"))


@query("weather_shift", with_ship("""
SELECT Weather_Condition, round(a, 6) AS train_share, round(b, 6) AS test_share, round(b - a, 6) AS difference FROM (
  SELECT Weather_Condition, count(*) FILTER (split = 'train') / (SELECT count(*) FROM holdout WHERE split = 'train') AS a,
    count(*) FILTER (split = 'test') / (SELECT count(*) FROM holdout WHERE split = 'test') AS b FROM holdout GROUP BY 1)""", SCORED, POSITION, HOLDOUT))
def weather_shift(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Shipment_Date", "Weather_Condition"]).withColumn("Full_Date", day())
    return rounded(metrics.distribution_shift(splits.chronological_holdout(df)))


@query("tier_shares", with_ship("SELECT Risk_Level, count(*) AS shipments, round(count(*) / (SELECT count(*) FROM scored), 6) AS share FROM scored GROUP BY 1", SCORED))
def tier_shares(spark, sf):
    return rounded(metrics.category_shares(stored_scores(spark, sf), "Risk_Level"))


@query("majority_baseline", with_ship("SELECT round(greatest(avg(is_delayed), 1 - avg(is_delayed)), 6) AS majority_share FROM scored", SCORED))
def majority_baseline(spark, sf):
    return rounded(metrics.majority_baseline(dated(spark, sf)))


@query("training_profile", with_ship("""
SELECT count(*) AS n_rows, round_even(avg(is_delayed), 4)::DOUBLE AS positive_rate, min(Full_Date) AS date_min, max(Full_Date) AS date_max,
  min(Distance_km) AS distance_min, max(Distance_km) AS distance_max, min(Weight_tons) AS weight_min, max(Weight_tons) AS weight_max,
  (SELECT string_agg(w, ',' ORDER BY w) FROM (SELECT DISTINCT Weather_Condition AS w FROM scored)) AS weather_levels,
  (SELECT string_agg(w, ',' ORDER BY w) FROM (SELECT DISTINCT Vehicle_Type AS w FROM scored)) AS vehicle_levels FROM scored""", SCORED))
def training_profile(spark, sf):
    from cargolume.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

    df = dated(spark, sf, ["Distance_km", "Weight_tons", "Vendor_Rating", *CATEGORICAL_FEATURES])
    out = metrics.training_profile(df, NUMERIC_FEATURES, CATEGORICAL_FEATURES)

    def span(name, end):
        return F.col("numeric_ranges")[name][end]

    def levels(name):
        return F.array_join(F.col("categorical_levels")[name], ",")

    return out.select("n_rows", "positive_rate", "date_min", "date_max", span("Distance_km", "min").alias("distance_min"),
                      span("Distance_km", "max").alias("distance_max"), span("Weight_tons", "min").alias("weight_min"),
                      span("Weight_tons", "max").alias("weight_max"), levels("Weather_Condition").alias("weather_levels"),
                      levels("Vehicle_Type").alias("vehicle_levels"))


@query("month_weather_percent", with_ship("""
SELECT CAST(month(Full_Date) AS INTEGER) AS "Month", """ + ", ".join(
    f"round_even(count_if(Weather_Condition = '{w}') / count(*) * 100.0::DOUBLE, 1)::DOUBLE AS \"{w}\"" for w in P.WEATHER) + """,
  count(*) AS Shipments, round_even(avg(is_delayed) * 100.0::DOUBLE, 1)::DOUBLE AS Delay_Percent FROM scored GROUP BY 1""", SCORED))
def month_weather_percent(spark, sf):
    return kpis.month_weather_pivot(shipments(spark, sf, ["Shipment_Date", "Weather_Condition", "Actual_Delay_Days"]))


@query("month_weather_counts", with_ship('SELECT CAST(month(Full_Date) AS INTEGER) AS "Month", ' + ", ".join(
    f"CAST(count_if(Weather_Condition = '{w}') AS BIGINT) AS \"{w}\"" for w in P.WEATHER) + " FROM scored GROUP BY 1", SCORED))
def month_weather_counts(spark, sf):
    return kpis.month_weather_counts(shipments(spark, sf, ["Shipment_Date", "Weather_Condition"]))


@query("mean_delay_by_weather", with_ship(
    "SELECT Weather_Condition, round_even(avg(Actual_Delay_Days), 2)::DOUBLE AS mean_delay_days FROM scored GROUP BY 1", SCORED))
def mean_delay_by_weather(spark, sf):
    return kpis.mean_delay_by_weather(shipments(spark, sf, ["Weather_Condition", "Actual_Delay_Days"]))


@query("mean_co2_by_vehicle", with_ship("SELECT Vehicle_Type, round(avg(CO2_Emission_kg), 6) AS mean_co2_kg FROM scored GROUP BY 1", SCORED))
def mean_co2_by_vehicle(spark, sf):
    return rounded(kpis.mean_co2_by_vehicle(shipments(spark, sf, ["Vehicle_Type", "CO2_Emission_kg"])))


MEASURES_SQL = """count(*) AS total_shipments, round(sum(CO2_Emission_kg) / 1000, 6) AS total_co2_tons, round(sum(CO2_Emission_kg) / 1000 * 50, 6) AS carbon_tax_impact,
  round(avg(Actual_Delay_Days), 6) AS average_delay_days, round(count_if(Risk_Level = 'High Risk') / count(*), 6) AS high_risk_rate, round(avg(p), 6) AS average_probability"""


@query("report_measures", with_ship(f"SELECT {MEASURES_SQL} FROM scored", SCORED))
def report_measures(spark, sf):
    return rounded(kpis.report(scored_view(spark, sf), parameters=kpis.parameter_table(spark)))


@query("report_by_tier", with_ship(f"SELECT Risk_Level, {MEASURES_SQL} FROM scored GROUP BY 1", SCORED))
def report_by_tier(spark, sf):
    return rounded(kpis.report(scored_view(spark, sf), ["Risk_Level"]))


@query("report_cube", with_ship(f"SELECT Vehicle_Type, Weather_Condition, Risk_Level, {MEASURES_SQL} FROM scored GROUP BY CUBE (Vehicle_Type, Weather_Condition, Risk_Level)", SCORED))
def report_cube(spark, sf):
    df = scored_view(spark, sf, ["Vehicle_Type", "Weather_Condition"])
    return rounded(kpis.report(df, ["Vehicle_Type", "Weather_Condition", "Risk_Level"], "cube"))


@query("shipment_risk_table", with_ship("""
SELECT Shipment_ID, Weather_Condition, Risk_Level, Vendor_ID, round(avg(p), 4) AS average_probability FROM scored GROUP BY ALL""", SCORED))
def shipment_risk_table(spark, sf):
    df = scored_view(spark, sf, ["Weather_Condition", "Vendor_ID"])
    return rounded(df.groupBy("Shipment_ID", "Weather_Condition", "Risk_Level", "Vendor_ID").agg(
        F.avg("Delay_Risk_Probability").alias("average_probability")), 4)


@query("delay_trend", with_ship("""
SELECT CAST(year(Full_Date) AS INTEGER) AS "Year", 'Q' || quarter(Full_Date) AS Quarter, CAST(month(Full_Date) AS INTEGER) AS "Month", count(*) AS shipments,
  round(avg(is_delayed), 6) AS delay_rate, round(avg(Actual_Delay_Days), 6) AS average_delay, round(avg(p) - avg(is_delayed), 6) AS predicted_minus_actual,
  round(sum(CO2_Emission_kg) / 1000 / count(*), 6) AS co2_tons_per_shipment
FROM scored GROUP BY ROLLUP (year(Full_Date), 'Q' || quarter(Full_Date), month(Full_Date))""", SCORED))
def delay_trend(spark, sf):
    df = scored_view(spark, sf).select(
        "*", F.year(day()).alias("Year"), F.concat(F.lit("Q"), F.quarter(day())).alias("Quarter"), F.month(day()).alias("Month"))
    return rounded(kpis.trend(df))


@query("season_trend", with_ship("""
SELECT CASE WHEN month(Full_Date) IN (12, 1, 2) THEN 'Winter' WHEN month(Full_Date) <= 5 THEN 'Spring' WHEN month(Full_Date) <= 8 THEN 'Summer' ELSE 'Autumn' END AS Season,
  count(*) AS shipments, round(avg(is_delayed), 6) AS delay_rate, round(avg(Actual_Delay_Days), 6) AS average_delay,
  round(avg(p) - avg(is_delayed), 6) AS predicted_minus_actual, round(sum(CO2_Emission_kg) / 1000 / count(*), 6) AS co2_tons_per_shipment
FROM scored GROUP BY ROLLUP (1)""", SCORED))
def season_trend(spark, sf):
    df = scored_view(spark, sf).withColumn("Season", season(F.month(day())))
    return rounded(kpis.trend(df, ["Season"]))


QUART = """quart AS (SELECT *, CASE WHEN {c} <= q1 THEN 1 WHEN {c} <= q2 THEN 2 WHEN {c} <= q3 THEN 3 ELSE 4 END AS q
  FROM scored, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM scored))"""


@query("delay_by_weather_and_rating", with_ship("""
SELECT Weather_Condition, CAST(q AS INTEGER) AS rating_quartile, count(*) AS shipments, round(avg(is_delayed), 6) AS delay_rate FROM quart GROUP BY 1, 2""",
    SCORED, QUART.format(c="Vendor_Rating")))
def delay_by_weather_and_rating(spark, sf):
    return rounded(kpis.delay_by_weather_and_rating(shipments(spark, sf, ["Weather_Condition", "Vendor_Rating", "Actual_Delay_Days"])))


@query("key_influencers", with_ship("""
SELECT factor, level, n AS shipments, round(k / n, 6) AS rate, round((tk - k) / (tn - n), 6) AS rate_elsewhere, round((k / n) / ((tk - k) / (tn - n)), 6) AS lift
FROM (SELECT 'Vendor_Rating' AS factor, 'Q' || q AS level, count(*) AS n, count_if(Risk_Level = 'High Risk') AS k FROM quart GROUP BY 2
  UNION ALL SELECT 'Traffic_Density', Traffic_Density, count(*), count_if(Risk_Level = 'High Risk') FROM quart GROUP BY 2
  UNION ALL SELECT 'Weather_Condition', Weather_Condition, count(*), count_if(Risk_Level = 'High Risk') FROM quart GROUP BY 2),
  (SELECT count(*) AS tn, count_if(Risk_Level = 'High Risk') AS tk FROM quart)""", SCORED, QUART.format(c="Vendor_Rating")))
def key_influencers(spark, sf):
    return rounded(kpis.key_influencers(scored_view(spark, sf, ["Vendor_Rating", "Traffic_Density", "Weather_Condition"])))


@query("days_without_shipments", with_ship("SELECT Date_ID, Full_Date FROM dim_date WHERE Date_ID NOT IN (SELECT Date_ID FROM fact)", FACT_SQL, DATE_SQL))
def days_without_shipments(spark, sf):
    t = star_tables(spark, sf)
    return kpis.days_without_shipments(t["dim_date"], t["fact"]).select("Date_ID", "Full_Date")


@query("etl_summary", with_ship("""
SELECT 'fact_shipments' AS "table", count(*) AS "rows" FROM fact UNION ALL SELECT 'dim_vendor', count(*) FROM dim_vendor
UNION ALL SELECT 'dim_route', count(*) FROM dim_route UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'days_without_shipments', count(*) FROM dim_date WHERE Date_ID NOT IN (SELECT Date_ID FROM fact)""", FACT_SQL, VENDOR_SQL, ROUTE_SQL, DATE_SQL))
def etl_summary(spark, sf):
    t = star_tables(spark, sf)
    return kpis.etl_summary(t["fact"], t["dim_vendor"], t["dim_route"], t["dim_date"])


@query("shipment_summary", with_ship("""
SELECT count(*) AS "rows", min(Shipment_Date) AS first_day, max(Shipment_Date) AS last_day, count(DISTINCT Vendor_ID) AS vendors, round(avg(is_delayed), 6) AS delay_rate FROM scored""", SCORED))
def shipment_summary(spark, sf):
    return rounded(kpis.shipment_summary(shipments(spark, sf, ["Shipment_Date", "Vendor_ID", "Actual_Delay_Days"])))


@query("delay_day_histogram", with_ship("SELECT Actual_Delay_Days, count(*) AS shipments FROM ship GROUP BY 1"))
def delay_day_histogram(spark, sf):
    return kpis.delay_day_histogram(shipments(spark, sf, ["Actual_Delay_Days"]))


FIXED = """fixed AS (SELECT *, CASE Vehicle_Type WHEN 'Diesel Truck' THEN 8.0::DOUBLE WHEN 'Electric Semi' THEN 1.5::DOUBLE ELSE 4.0::DOUBLE END
  * CASE Weather_Condition WHEN 'Normal' THEN 1.0::DOUBLE WHEN 'Rain' THEN 1.03::DOUBLE WHEN 'Storm' THEN 1.08::DOUBLE ELSE 1.06::DOUBLE END
  * CASE Traffic_Density WHEN 'Low' THEN 1.0::DOUBLE WHEN 'Medium' THEN 1.04::DOUBLE ELSE 1.1::DOUBLE END AS base_kg FROM ship)"""
POOL_SQL = """SELECT CAST(window_days AS INTEGER) AS window_days, CAST(sum(n - 1) AS BIGINT) AS legs_eliminated, round(sum((n - 1) * kg / n), 6) AS saved_kg FROM (
  SELECT window_days, {k}, floor(date_diff('day', DATE '1970-01-01', CAST(Shipment_Date AS DATE)) / window_days) AS slot, count(*) AS n, sum(base_kg) AS kg
  FROM fixed, (VALUES (1), (7), (30)) w(window_days) GROUP BY ALL) GROUP BY 1"""
POOL_INPUTS = ["Origin", "Destination", "Shipment_Date", "Vehicle_Type", "Weather_Condition", "Traffic_Density"]


@query("corridor_pooling", with_ship(POOL_SQL.format(k="Origin, Destination"), FIXED))
def corridor_pooling(spark, sf):
    return rounded(kpis.corridor_pooling(shipments(spark, sf, POOL_INPUTS)))


@query("corridor_pooling_by_vehicle", with_ship(POOL_SQL.format(k="Origin, Destination, Vehicle_Type"), FIXED))
def corridor_pooling_by_vehicle(spark, sf):
    return rounded(kpis.corridor_pooling(shipments(spark, sf, POOL_INPUTS), by_vehicle=True))


@query("fixed_emission_share", with_ship("SELECT round(sum(base_kg), 4) AS fixed_kg, round(sum(co2_formula), 4) AS total_kg, round(sum(base_kg) / sum(co2_formula), 4) AS fixed_share FROM fixed", FIXED))
def fixed_emission_share(spark, sf):
    return rounded(kpis.fixed_emission_share(shipments(spark, sf, CO2_INPUTS)), 4)


@query("fleet_by_distance_quartile", with_ship("""
SELECT CAST(q AS INTEGER) AS distance_quartile, count(*) AS shipments, round(avg((Vehicle_Type = 'Diesel Truck')::INT), 6) AS vehicle_share FROM quart GROUP BY 1""",
    SCORED, QUART.format(c="Distance_km")))
def fleet_by_distance_quartile(spark, sf):
    return rounded(kpis.fleet_by_distance(shipments(spark, sf, ["Distance_km", "Vehicle_Type"])))


@query("fleet_by_vendor", with_ship("""
SELECT round(min(k / n), 6) AS min_share, round(max(k / n), 6) AS max_share, round(stddev_samp(k / n), 6) AS sd_share, round(sum(k) / sum(n), 6) AS fleet_share
FROM (SELECT Vendor_ID, count(*) AS n, count_if(Vehicle_Type = 'Diesel Truck') AS k FROM ship GROUP BY 1)"""))
def fleet_by_vendor(spark, sf):
    return rounded(kpis.fleet_by_vendor(shipments(spark, sf, ["Vendor_ID", "Vehicle_Type"])))


@query("score_ceiling", with_ship(f"SELECT Vehicle_Type, round({AUC_SQL.format(s='raw_score', t='(SELECT * FROM scored x WHERE x.Vehicle_Type = v.Vehicle_Type)')}, 6) AS roc_auc FROM (SELECT DISTINCT Vehicle_Type FROM ship) v", SCORED))
def score_ceiling(spark, sf):
    return rounded(metrics.roc_auc(labelled(spark, sf, ["Vehicle_Type"]), "raw_score", by=["Vehicle_Type"]))


@query("delay_rate_offset")
def delay_rate_offset(spark, sf):
    """The offset that brings the mean score to the target, and the mean it gives."""
    from cargolume.session import materialise

    df = materialise(shipments(spark, sf, ["Vendor_Rating", "Distance_km", "Weather_Condition", "Traffic_Density"])
                     .select(fx.delay_index().alias("x")), "index")
    offset = kpis.solve_offset(df, "x")
    return df.agg(F.lit(offset).alias("offset"), F.avg(fx.sigmoid(F.col("x") + offset)).alias("mean_probability"),
                  F.count("*").alias("shipments"))


@query("parameter_table", with_ship("""
SELECT parameter, value, round(CASE parameter WHEN 'Carbon_Price_Per_Ton' THEN tons * value WHEN 'High_Risk_Threshold' THEN high WHEN 'Medium_Risk_Threshold' THEN medium
  ELSE missed * value + false_alerts END, 4)::DOUBLE AS measure
FROM (VALUES ('Carbon_Price_Per_Ton', 50.0::DOUBLE), ('High_Risk_Threshold', 0.5::DOUBLE), ('Medium_Risk_Threshold', 0.2::DOUBLE), ('Cost_FN_Over_FP', 4.0::DOUBLE)) v(parameter, value),
  (SELECT sum(CO2_Emission_kg) / 1000.0::DOUBLE AS tons, count_if(raw_score >= 0.5) AS high, count_if(raw_score >= 0.2) AS medium,
    count_if(raw_score < 0.2 AND Actual_Delay_Days > 0) AS missed, count_if(raw_score >= 0.2 AND Actual_Delay_Days <= 0) AS false_alerts FROM ship)"""))
def parameter_table(spark, sf):
    """Each report parameter with the measure that it drives: carbon cost, shipments per threshold, alert cost."""
    df = shipments(spark, sf, ["CO2_Emission_kg", "raw_score", "Actual_Delay_Days"])
    value = {r["parameter"]: r["value"] for r in kpis.parameter_table(spark).collect()}
    high, medium = value["High_Risk_Threshold"], value["Medium_Risk_Threshold"]
    late, alert = F.col("Actual_Delay_Days") > 0, F.col("raw_score") >= medium
    totals = df.agg((F.sum("CO2_Emission_kg") / 1000.0).alias("tons"), F.count_if(F.col("raw_score") >= high).alias("high"),
                    F.count_if(alert).alias("medium"), F.count_if(late & ~alert).alias("missed"), F.count_if(~late & alert).alias("false_alerts"))
    measure = (F.when(F.col("parameter") == "Carbon_Price_Per_Ton", F.col("tons") * F.col("value")).when(F.col("parameter") == "High_Risk_Threshold", F.col("high"))
               .when(F.col("parameter") == "Medium_Risk_Threshold", F.col("medium")).otherwise(F.col("missed") * F.col("value") + F.col("false_alerts")))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("parameter"), F.lit(v).alias("value")) for k, v in value.items()]))
    return rounded(totals.select("*", rows.alias("x")).select("*", "x.*").select("parameter", "value", measure.alias("measure")), 4)

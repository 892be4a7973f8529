"""Queries on the view, the formulas and the row-level projections."""

from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions import formulas as fx
from cargolume.functions import keys
from cargolume.queries.base import query, with_ship
from cargolume.sources.shipments import shipments

CO2_INPUTS = ["Distance_km", "Weight_tons", "Vehicle_Type", "Weather_Condition", "Traffic_Density"]


def r(column, digits=6):
    return F.round(column, digits)


@query("co2_tons_by_vehicle", with_ship("""
SELECT Vehicle_Type, count(*) AS shipments, round(sum(co2_formula) / 1000, 6) AS co2_tons
FROM ship GROUP BY Vehicle_Type"""))
def co2_tons_by_vehicle(spark, sf):
    df = shipments(spark, sf, CO2_INPUTS)
    return df.groupBy("Vehicle_Type").agg(
        F.count("*").alias("shipments"), r(F.sum(fx.co2_kg()) / 1000).alias("co2_tons"))


@query("raw_shipments", with_ship("""
SELECT Shipment_ID, Shipment_Date, Vendor_ID, Vendor_Rating, Origin, Destination,
  Distance_km, Weight_tons, Weather_Condition, Traffic_Density, Vehicle_Type,
  Actual_Delay_Days, CO2_Emission_kg FROM ship"""))
def raw_shipments(spark, sf):
    df = shipments(spark, sf)
    return df.select("Shipment_ID", "Shipment_Date", "Vendor_ID", "Vendor_Rating",
                     "Origin", "Destination", "Distance_km", "Weight_tons",
                     "Weather_Condition", "Traffic_Density", "Vehicle_Type", "Actual_Delay_Days",
                     "CO2_Emission_kg")


@query("co2_per_shipment", with_ship(
    "SELECT Shipment_ID, co2_formula AS co2_kg, co2_formula / 1000.0::DOUBLE * 50.0::DOUBLE AS carbon_cost FROM ship"))
def co2_per_shipment(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", *CO2_INPUTS])
    return df.select("Shipment_ID", fx.co2_kg().alias("co2_kg"),
                     fx.carbon_cost(fx.co2_kg()).alias("carbon_cost"))


@query("carbon_cost_by_price", with_ship("""
SELECT price, Vehicle_Type, round(sum(co2_formula) / 1000 * price, 4) AS carbon_cost
FROM ship, (VALUES (25.0::DOUBLE), (50.0::DOUBLE), (85.0::DOUBLE)) v(price) GROUP BY price, Vehicle_Type"""))
def carbon_cost_by_price(spark, sf):
    df = shipments(spark, sf, CO2_INPUTS)
    totals = df.groupBy("Vehicle_Type").agg(F.sum(fx.co2_kg()).alias("kg"))
    priced = totals.withColumn("price", F.explode(F.array(*[F.lit(p) for p in (25.0, 50.0, 85.0)])))
    return priced.select("price", "Vehicle_Type", r(fx.carbon_cost("kg", F.col("price")), 4).alias("carbon_cost"))


@query("freight_cost_per_shipment", with_ship("""
SELECT Shipment_ID, Distance_km * Weight_tons * CASE Vehicle_Type WHEN 'Diesel Truck' THEN 0.085::DOUBLE WHEN 'Electric Semi' THEN 0.062::DOUBLE ELSE 0.098::DOUBLE END
  + CASE Vehicle_Type WHEN 'Diesel Truck' THEN 42.0::DOUBLE WHEN 'Electric Semi' THEN 96.0::DOUBLE ELSE 28.0::DOUBLE END AS freight,
  Distance_km * Weight_tons * CASE Vehicle_Type WHEN 'Diesel Truck' THEN 0.1::DOUBLE WHEN 'Electric Semi' THEN 0.05::DOUBLE ELSE 0.2::DOUBLE END
  + CASE Vehicle_Type WHEN 'Diesel Truck' THEN 42.0::DOUBLE WHEN 'Electric Semi' THEN 96.0::DOUBLE ELSE 28.0::DOUBLE END AS freight_other_rates FROM ship"""))
def freight_cost_per_shipment(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Distance_km", "Weight_tons", "Vehicle_Type"])
    other = {"Diesel Truck": 0.1, "Electric Semi": 0.05, "Hybrid Van": 0.2}
    return df.select("Shipment_ID", fx.freight_cost().alias("freight"),
                     fx.freight_cost(rates=other).alias("freight_other_rates"))


@query("risk_tiers", with_ship("""
SELECT Shipment_ID, CASE WHEN raw_score >= 0.5 THEN 'High Risk' WHEN raw_score >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS tier,
  CASE WHEN raw_score >= 0.6 THEN 'High Risk' WHEN raw_score >= 0.35 THEN 'Medium Risk' ELSE 'Low Risk' END AS tier_custom FROM ship"""))
def risk_tiers(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    return df.select("Shipment_ID", fx.risk_tier("raw_score").alias("tier"),
                     fx.risk_tier("raw_score", 0.6, 0.35).alias("tier_custom"))


@query("threshold_by_cost_ratio", """
SELECT DISTINCT CAST(l_linenumber AS DOUBLE) AS cost_ratio, round_even(1.0::DOUBLE / (1.0::DOUBLE + l_linenumber), 2)::DOUBLE AS threshold FROM lineitem""")
def threshold_by_cost_ratio(spark, sf):
    ratios = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_linenumber").cast("double").alias("cost_ratio")).distinct()
    return ratios.select("cost_ratio", fx.cost_threshold("cost_ratio").alias("threshold"))


@query("expected_delay_cost", with_ship(
    "SELECT Shipment_ID, round(raw_score * 850 + 12.5, 6) AS expected_cost FROM ship"))
def expected_delay_cost(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    return df.select("Shipment_ID", r(fx.expected_delay_cost("raw_score", P.SLA_PENALTY, 12.5)).alias("expected_cost"))


@query("binary_target", with_ship(
    "SELECT Shipment_ID, CAST(Actual_Delay_Days > 0 AS INTEGER) AS is_delayed FROM ship"))
def binary_target(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Actual_Delay_Days"])
    return df.select("Shipment_ID", fx.is_delayed().alias("is_delayed"))


@query("stored_score_and_tier", with_ship("""
SELECT Shipment_ID, p AS Delay_Risk_Probability, CASE WHEN p >= 0.5 THEN 'High Risk' WHEN p >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level
FROM (SELECT Shipment_ID, round_even(raw_score, 2)::DOUBLE AS p FROM ship)"""))
def stored_score_and_tier(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    p = fx.stored_probability("raw_score")
    return df.select("Shipment_ID", p.alias("Delay_Risk_Probability"), fx.risk_tier(p).alias("Risk_Level"))


@query("extrapolation_flags", with_ship("""
SELECT Shipment_ID,
  concat_ws('|', CASE WHEN Distance_km < 100 THEN 'Distance_km low' WHEN Distance_km > 1200 THEN 'Distance_km high' END,
    CASE WHEN Weight_tons < 2 THEN 'Weight_tons low' WHEN Weight_tons > 22 THEN 'Weight_tons high' END,
    CASE WHEN Vendor_Rating < 1.75 THEN 'Vendor_Rating low' WHEN Vendor_Rating > 4.65 THEN 'Vendor_Rating high' END) AS flags FROM ship"""))
def extrapolation_flags(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Distance_km", "Weight_tons", "Vendor_Rating"])
    out = fx.outside_range({"Distance_km": (100.0, 1200.0), "Weight_tons": (2.0, 22.0), "Vendor_Rating": (1.75, 4.65)})
    short = F.transform(out, lambda x: F.concat_ws(" ", x["feature"], x["side"]))
    return df.select("Shipment_ID", F.array_join(short, "|").alias("flags"))


@query("unknown_categories", with_ship("""
SELECT 'Weather_Condition' AS field, Weather_Condition AS value, 'Normal, Rain' AS accepted, count(*) AS shipments FROM ship
WHERE Weather_Condition NOT IN ('Normal', 'Rain') GROUP BY Weather_Condition
UNION ALL SELECT 'Vehicle_Type', Vehicle_Type, 'Diesel Truck, Hybrid Van', count(*) FROM ship
WHERE Vehicle_Type NOT IN ('Diesel Truck', 'Hybrid Van') GROUP BY Vehicle_Type"""))
def unknown_categories(spark, sf):
    df = shipments(spark, sf, ["Weather_Condition", "Vehicle_Type"])
    return fx.unknown_categories(df, {"Weather_Condition": ["Normal", "Rain"],
                                      "Vehicle_Type": ["Diesel Truck", "Hybrid Van"]})


@query("route_keys", with_ship("""
SELECT Shipment_ID, 'RT-' || substr(sha1(concat_ws(chr(31), Origin, Destination, Vehicle_Type, Weather_Condition, Traffic_Density)), 1, 10) AS Route_ID FROM ship"""))
def route_keys(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Origin", "Destination", "Vehicle_Type", "Weather_Condition",
                               "Traffic_Density"])
    return df.select("Shipment_ID", keys.route_key().alias("Route_ID"))


@query("logit_sigmoid_roundtrip", with_ship("""
SELECT Shipment_ID, round(ln(p / (1 - p)), 6) AS log_odds, round(1 / (1 + exp(-(0.8 * ln(p / (1 - p)) - 0.3))), 6) AS shifted
FROM (SELECT Shipment_ID, least(greatest(raw_score, 1e-6), 1 - 1e-6) AS p FROM ship)"""))
def logit_sigmoid_roundtrip(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    z = fx.logit("raw_score")
    return df.select("Shipment_ID", r(z).alias("log_odds"), r(fx.sigmoid(z * 0.8 - 0.3)).alias("shifted"))


@query("delay_risk_index", with_ship(
    "SELECT Shipment_ID, round(raw_score, 6) AS raw_score, round(ln(raw_score / (1 - raw_score)) + 2.7, 6) AS delay_index FROM ship"))
def delay_risk_index(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score", "Vendor_Rating", "Distance_km", "Weather_Condition",
                               "Traffic_Density"])
    return df.select("Shipment_ID", r("raw_score").alias("raw_score"), r(fx.delay_index()).alias("delay_index"))


@query("unknown_and_parent_features", """
SELECT feature, CASE WHEN feature LIKE 'Weather_Condition_%' THEN 'Weather_Condition' WHEN feature LIKE 'Traffic_Density_%' THEN 'Traffic_Density'
  WHEN feature LIKE 'Vehicle_Type_%' THEN 'Vehicle_Type' ELSE feature END AS parent, parts
FROM (SELECT CASE WHEN p_size % 4 = 0 THEN 'Distance_km' ELSE
  CASE p_size % 4 WHEN 1 THEN 'Weather_Condition_' WHEN 2 THEN 'Traffic_Density_' ELSE 'Vehicle_Type_' END || p_type END AS feature, count(*) AS parts
FROM part GROUP BY 1)""")
def parent_features(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    k = F.col("p_size") % 4
    name = F.when(k == 0, F.lit("Distance_km")).otherwise(F.concat(
        F.when(k == 1, "Weather_Condition_").when(k == 2, "Traffic_Density_").otherwise("Vehicle_Type_"),
        F.col("p_type")))
    names = part.select(name.alias("feature")).groupBy("feature").agg(F.count("*").alias("parts"))
    return names.select("feature", fx.parent_feature().alias("parent"), "parts")

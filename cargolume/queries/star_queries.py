"""Queries on the star schema, contracts and integrity."""

from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.operators import contracts as ct
from cargolume.operators import star
from cargolume.queries.base import query, with_ship
from cargolume.queries.formula_queries import CO2_INPUTS, r
from cargolume.schemas import FACT_COLUMNS, FEATURES, RAW_COLUMNS, ROUTE_COLUMNS
from cargolume.session import materialise
from cargolume.sources.shipments import shipments

# The view's ids differ from those of the contract's defaults.
SHIPMENT_PATTERN, VENDOR_PATTERN = r"^\d+-\d+-\d+-\d+-\d+$", r"^VEND-\d{5,}$"

ROUTE_KEY_SQL = ("'RT-' || substr(sha1(concat_ws(chr(31), Origin, Destination, Vehicle_Type, Weather_Condition, "
                 "Traffic_Density)), 1, 10)")
DATE_KEY_SQL = "CAST(replace(Shipment_Date, '-', '') AS INTEGER)"
FACT_SQL = f"""fact AS (SELECT Shipment_ID, {DATE_KEY_SQL} AS Date_ID, Vendor_ID, {ROUTE_KEY_SQL} AS Route_ID,
  Weight_tons, Distance_km, Actual_Delay_Days, CO2_Emission_kg FROM ship)"""
VENDOR_SQL = """dim_vendor AS (SELECT Vendor_ID, round_even(avg(Vendor_Rating), 2)::DOUBLE AS Vendor_Rating FROM ship GROUP BY Vendor_ID)"""
ROUTE_SQL = f"""dim_route AS (SELECT DISTINCT {ROUTE_KEY_SQL} AS Route_ID, Origin, Destination, Vehicle_Type, Weather_Condition, Traffic_Density FROM ship)"""
DATE_SQL = """dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS Date_ID, CAST(d AS DATE) AS Full_Date,
  CAST(year(d) AS INTEGER) AS Year, 'Q' || quarter(d) AS Quarter, CAST(month(d) AS INTEGER) AS Month, monthname(d) AS Month_Name,
  strftime(d, '%Y-%m') AS Month_Year,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring' WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS Season,
  dayname(d) AS Day_Of_Week, isodow(d) >= 6 AS Is_Weekend
  FROM (SELECT unnest(generate_series((SELECT min(CAST(Shipment_Date AS DATE)) FROM ship), (SELECT max(CAST(Shipment_Date AS DATE)) FROM ship), INTERVAL 1 DAY)) AS d))"""
STAR_SQL = (FACT_SQL, VENDOR_SQL, ROUTE_SQL, DATE_SQL)


def star_tables(spark, sf):
    raw = shipments(spark, sf, RAW_COLUMNS)
    return {"fact": star.fact_shipments(raw),
            "dim_vendor": star.dim_vendor(shipments(spark, sf, ["Vendor_ID", "Vendor_Rating"])),
            "dim_route": star.dim_route(shipments(spark, sf, ROUTE_COLUMNS)),
            "dim_date": star.dim_date(shipments(spark, sf, ["Shipment_Date"]))}


@query("dim_vendor", with_ship("SELECT * FROM dim_vendor", VENDOR_SQL))
def dim_vendor(spark, sf):
    return star_tables(spark, sf)["dim_vendor"].orderBy("Vendor_ID")


@query("dim_route", with_ship("SELECT * FROM dim_route", ROUTE_SQL))
def dim_route(spark, sf):
    return star_tables(spark, sf)["dim_route"].orderBy(*ROUTE_COLUMNS)


@query("dim_date", with_ship("SELECT * FROM dim_date", DATE_SQL))
def dim_date(spark, sf):
    return star_tables(spark, sf)["dim_date"]


@query("fact_shipments", with_ship("SELECT * FROM fact", FACT_SQL))
def fact_shipments(spark, sf):
    return star_tables(spark, sf)["fact"]


@query("fact_by_route_lookup", with_ship("""
SELECT f.Shipment_ID, f.Date_ID, f.Vendor_ID, r.Route_ID, f.Weight_tons, f.Distance_km, f.Actual_Delay_Days, f.CO2_Emission_kg
FROM fact f LEFT JOIN dim_route r USING (Route_ID)""", FACT_SQL, ROUTE_SQL))
def fact_by_route_lookup(spark, sf):
    raw = shipments(spark, sf, RAW_COLUMNS)
    return star.fact_by_lookup(raw, star_tables(spark, sf)["dim_route"])


@query("analytical_dataset", with_ship("""
SELECT f.*, v.Vendor_Rating, r.Origin, r.Destination, r.Vehicle_Type, r.Weather_Condition, r.Traffic_Density,
  d.Full_Date, d.Month, d.Season, CAST(f.Actual_Delay_Days > 0 AS INTEGER) AS is_delayed
FROM fact f LEFT JOIN dim_vendor v USING (Vendor_ID) LEFT JOIN dim_route r USING (Route_ID) LEFT JOIN dim_date d USING (Date_ID)""", *STAR_SQL))
def analytical_dataset(spark, sf):
    t = star_tables(spark, sf)
    return star.analytical_dataset(t["fact"], t["dim_vendor"], t["dim_route"], t["dim_date"])


@query("allocation_input", with_ship("""
SELECT f.*, v.Vendor_Rating, r.Origin, r.Destination, r.Vehicle_Type, r.Weather_Condition, r.Traffic_Density
FROM fact f LEFT JOIN dim_route r USING (Route_ID) LEFT JOIN dim_vendor v USING (Vendor_ID)""", *STAR_SQL[:3]))
def allocation_input(spark, sf):
    t = star_tables(spark, sf)
    # Stored, the dimensions' sizes are known: while they are small, the fact is not shuffled for them.
    return star.allocation_input(t["fact"], *[materialise(t[n], n) for n in ("dim_route", "dim_vendor")])


@query("scored_fact", with_ship("""
SELECT f.*, round_even(raw_score, 2)::DOUBLE AS Delay_Risk_Probability,
  CASE WHEN round_even(raw_score, 2) >= 0.5 THEN 'High Risk' WHEN round_even(raw_score, 2) >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level
FROM fact f LEFT JOIN ship s USING (Shipment_ID)""".replace("f.*", ", ".join("f." + c for c in FACT_COLUMNS)), FACT_SQL))
def scored_fact(spark, sf):
    return star.attach_scores(star_tables(spark, sf)["fact"], stored_scores(spark, sf))


def stored_scores(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "raw_score"])
    p = fx.stored_probability("raw_score")
    return df.select("Shipment_ID", p.alias("Delay_Risk_Probability"), fx.risk_tier(p).alias("Risk_Level"))


@query("orphan_routes", with_ship("""
SELECT Route_ID, count(*) AS shipments FROM fact WHERE Route_ID NOT IN (SELECT Route_ID FROM dim_route)
GROUP BY Route_ID UNION ALL SELECT Route_ID, -count(*) FROM dim_route WHERE Route_ID NOT IN (SELECT Route_ID FROM fact) GROUP BY Route_ID
UNION ALL SELECT 'resolved', count(*) FROM fact WHERE Route_ID IN (SELECT Route_ID FROM dim_route)""", FACT_SQL, ROUTE_SQL))
def orphan_routes(spark, sf):
    """Shipments per route that the dimension lacks, routes without shipments (negative), and how many shipments resolve."""
    t = star_tables(spark, sf)
    lost = ct.orphan_keys(t["fact"], t["dim_route"], "Route_ID")
    unused = ct.orphan_keys(t["dim_route"], t["fact"].select("Route_ID").distinct(), "Route_ID").withColumn("shipments", -F.col("shipments"))
    found = t["fact"].join(t["dim_route"].select("Route_ID"), "Route_ID", "left_semi")
    return lost.unionByName(unused).unionByName(found.agg(F.lit("resolved").alias("Route_ID"), F.count("*").alias("shipments")))


@query("new_routes_since", with_ship(f"""
SELECT DISTINCT {ROUTE_KEY_SQL} AS Route_ID, Origin, Destination, Vehicle_Type, Weather_Condition, Traffic_Density FROM ship
WHERE {ROUTE_KEY_SQL} NOT IN (SELECT {ROUTE_KEY_SQL} FROM ship WHERE Shipment_Date < '2000-01-01')"""))
def new_routes_since(spark, sf):
    raw = shipments(spark, sf, ["Shipment_Date", *ROUTE_COLUMNS])
    existing = star.dim_route(raw.where("Shipment_Date < '2000-01-01'"))
    return star.new_routes(existing, raw.where("Shipment_Date >= '2000-01-01'"))


@query("regrained_dimensions", with_ship("""
SELECT 'lane' AS dimension, count(*) AS members FROM (SELECT DISTINCT Origin, Destination FROM ship)
UNION ALL SELECT 'vehicle', count(*) FROM (SELECT DISTINCT Vehicle_Type FROM ship)
UNION ALL SELECT 'condition', count(*) FROM (SELECT DISTINCT Weather_Condition, Traffic_Density FROM ship)"""))
def regrained_dimensions(spark, sf):
    parts = star.regrained(shipments(spark, sf, ["Shipment_ID", *ROUTE_COLUMNS]))
    out = None
    for name in ("lane", "vehicle", "condition"):
        row = parts[name].agg(F.count_distinct(f"{name}_id").alias("members")).select(
            F.lit(name).alias("dimension"), "members")
        out = row if out is None else out.unionByName(row)
    return out


@query("regrained_fact", with_ship("""
SELECT Shipment_ID, 'LN-' || substr(sha1(concat_ws(chr(31), Origin, Destination)), 1, 10) AS lane_id,
  'VH-' || substr(sha1(Vehicle_Type), 1, 10) AS vehicle_id,
  'CN-' || substr(sha1(concat_ws(chr(31), Weather_Condition, Traffic_Density)), 1, 10) AS condition_id FROM ship"""))
def regrained_fact(spark, sf):
    return star.regrained(shipments(spark, sf, ["Shipment_ID", *ROUTE_COLUMNS]))["fact"]


@query("feature_projection", with_ship(
    "SELECT Distance_km, Weight_tons, Vendor_Rating, Weather_Condition, Traffic_Density, Vehicle_Type FROM ship"))
def feature_projection(spark, sf):
    return star.project_features(shipments(spark, sf, RAW_COLUMNS), FEATURES)


@query("column_differences", """
WITH have AS (SELECT column_name FROM information_schema.columns WHERE table_name = 'orders')
SELECT 'missing' AS kind, c AS column_name, 0 AS filled FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_shipmode')) v(c) WHERE c NOT IN (SELECT column_name FROM have)
UNION ALL SELECT 'unexpected', name, filled FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME name VALUE filled)
WHERE name NOT IN ('o_orderkey', 'o_custkey', 'o_shipmode')""", longs=("filled",))
def column_differences(spark, sf):
    """The orders table against an expected column list: missing and unexpected columns, with the rows that fill each."""
    from cargolume.sources.shipments import read_table

    df, expected = read_table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_shipmode"]
    kinds = {c: "missing" for c in star.missing_columns(df, expected)} | {c: "unexpected" for c in star.unexpected_columns(df, expected)}
    counts = df.agg(*[(F.count(c) if k == "unexpected" else F.lit(0).cast("long")).alias(c) for c, k in kinds.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c, k in kinds.items()])).alias("x")).select("x.*")


@query("raw_contract", with_ship("""
SELECT 'raw_shipments' AS "table", rule, violations FROM (
  SELECT unnest([{'rule': 'Shipment_ID matches', 'violations': count_if(NOT regexp_matches(Shipment_ID, '^\\d+-\\d+-\\d+-\\d+-\\d+$'))},
    {'rule': 'Shipment_Date matches', 'violations': count_if(NOT regexp_matches(Shipment_Date, '^\\d{4}-\\d{2}-\\d{2}$'))},
    {'rule': 'Vendor_ID matches', 'violations': count_if(NOT regexp_matches(Vendor_ID, '^VEND-\\d{5,}$'))},
    {'rule': 'Vendor_Rating in range', 'violations': count_if(NOT Vendor_Rating BETWEEN 1 AND 5)},
    {'rule': 'Origin not null', 'violations': count_if(Origin IS NULL)},
    {'rule': 'Destination not null', 'violations': count_if(Destination IS NULL)},
    {'rule': 'Distance_km in range', 'violations': count_if(NOT (Distance_km > 0 AND Distance_km <= 5000))},
    {'rule': 'Weight_tons in range', 'violations': count_if(NOT (Weight_tons > 0 AND Weight_tons <= 20))},
    {'rule': 'Weather_Condition in set', 'violations': count_if(Weather_Condition NOT IN ('Normal','Rain','Storm','Snow'))},
    {'rule': 'Traffic_Density in set', 'violations': count_if(Traffic_Density NOT IN ('Low','Medium','High'))},
    {'rule': 'Vehicle_Type in set', 'violations': count_if(Vehicle_Type NOT IN ('Diesel Truck','Electric Semi','Hybrid Van'))},
    {'rule': 'Actual_Delay_Days in range', 'violations': count_if(NOT Actual_Delay_Days BETWEEN 0 AND 30)},
    {'rule': 'CO2_Emission_kg in range', 'violations': count_if(NOT CO2_Emission_kg > 0)},
    {'rule': 'Shipment_ID unique', 'violations': (SELECT count(*) FROM (SELECT Shipment_ID FROM ship GROUP BY 1 HAVING count(*) > 1))}], recursive := true) FROM ship)"""), longs=("violations",))
def raw_contract(spark, sf):
    df = shipments(spark, sf, RAW_COLUMNS)
    rules = ct.raw_rules(SHIPMENT_PATTERN, VENDOR_PATTERN, max_weight=20.0)
    return ct.contract_report(df, "raw_shipments", rules, "Shipment_ID").drop("example")


@query("star_contracts", with_ship("""
SELECT 'dim_vendor' AS "table", 'Vendor_ID matches' AS rule, count_if(NOT regexp_matches(Vendor_ID, '^VEND-\\d{5,}$')) AS violations FROM dim_vendor
UNION ALL SELECT 'dim_vendor', 'Vendor_Rating in range', count_if(NOT Vendor_Rating BETWEEN 1 AND 5) FROM dim_vendor
UNION ALL SELECT 'dim_vendor', 'Vendor_ID unique', count(*) - count(DISTINCT Vendor_ID) FROM dim_vendor
UNION ALL SELECT 'dim_route', 'Route_ID matches', count_if(NOT regexp_matches(Route_ID, '^RT-[0-9a-f]{10}$')) FROM dim_route
UNION ALL SELECT 'dim_route', 'Origin not null', count_if(Origin IS NULL) FROM dim_route
UNION ALL SELECT 'dim_route', 'Destination not null', count_if(Destination IS NULL) FROM dim_route
UNION ALL SELECT 'dim_route', 'Vehicle_Type in set', count_if(Vehicle_Type NOT IN ('Diesel Truck','Electric Semi','Hybrid Van')) FROM dim_route
UNION ALL SELECT 'dim_route', 'Weather_Condition in set', count_if(Weather_Condition NOT IN ('Normal','Rain','Storm','Snow')) FROM dim_route
UNION ALL SELECT 'dim_route', 'Traffic_Density in set', count_if(Traffic_Density NOT IN ('Low','Medium','High')) FROM dim_route
UNION ALL SELECT 'dim_route', 'Route_ID unique', count(*) - count(DISTINCT Route_ID) FROM dim_route
UNION ALL SELECT 'scored', 'Shipment_ID matches', count_if(NOT regexp_matches(Shipment_ID, '^\\d+-\\d+-\\d+-\\d+-\\d+$')) FROM fact
UNION ALL SELECT 'scored', 'Date_ID in range', count_if(NOT Date_ID BETWEEN 19000101 AND 99991231) FROM fact
UNION ALL SELECT 'scored', 'Vendor_ID matches', count_if(NOT regexp_matches(Vendor_ID, '^VEND-\\d{5,}$')) FROM fact
UNION ALL SELECT 'scored', 'Route_ID matches', count_if(NOT regexp_matches(Route_ID, '^RT-[0-9a-f]{10}$')) FROM fact
UNION ALL SELECT 'scored', 'Weight_tons in range', count_if(NOT (Weight_tons > 0 AND Weight_tons <= 100)) FROM fact
UNION ALL SELECT 'scored', 'Distance_km in range', count_if(NOT (Distance_km > 0 AND Distance_km <= 5000)) FROM fact
UNION ALL SELECT 'scored', 'Actual_Delay_Days in range', count_if(NOT Actual_Delay_Days BETWEEN 0 AND 30) FROM fact
UNION ALL SELECT 'scored', 'CO2_Emission_kg in range', count_if(NOT CO2_Emission_kg > 0) FROM fact
UNION ALL SELECT 'scored', 'Delay_Risk_Probability in range', count_if(NOT raw_score BETWEEN 0 AND 1) FROM ship
UNION ALL SELECT 'scored', 'Risk_Level in set', 0 FROM (SELECT count(*) FROM ship)
UNION ALL SELECT 'scored', 'Shipment_ID unique', count(*) - count(DISTINCT Shipment_ID) FROM fact""", *STAR_SQL[:3]), longs=("violations",))
def star_contracts(spark, sf):
    t = star_tables(spark, sf)
    scored = star.attach_scores(t["fact"], stored_scores(spark, sf))
    out = ct.contract_report(t["dim_vendor"], "dim_vendor", ct.vendor_rules(VENDOR_PATTERN), "Vendor_ID")
    out = out.unionByName(ct.contract_report(t["dim_route"], "dim_route", ct.route_rules(), "Route_ID"))
    rules = ct.scored_rules(shipment_pattern=SHIPMENT_PATTERN, vendor_pattern=VENDOR_PATTERN)
    return out.unionByName(ct.contract_report(scored, "scored", rules, "Shipment_ID")).drop("example")


INTEGRITY_TAIL = """
UNION ALL SELECT 'fact.Vendor_ID resolves', count_if(v.Vendor_ID IS NULL) FROM fact f LEFT JOIN dim_vendor v USING (Vendor_ID)
UNION ALL SELECT 'fact.Route_ID resolves', count_if(r.Route_ID IS NULL) FROM fact f LEFT JOIN dim_route r USING (Route_ID)
UNION ALL SELECT 'fact.Date_ID resolves', count_if(d.Date_ID IS NULL) FROM fact f LEFT JOIN dim_date d USING (Date_ID)
UNION ALL SELECT 'fact.Shipment_ID unique', count(*) FROM (SELECT Shipment_ID FROM fact GROUP BY 1 HAVING count(*) > 1)"""


@query("star_integrity", with_ship("""
SELECT 'dim_vendor.Vendor_ID unique' AS "check", count(*) AS violations FROM (SELECT Vendor_ID FROM dim_vendor GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'dim_route.Route_ID unique', count(*) FROM (SELECT Route_ID FROM dim_route GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'dim_date.Date_ID unique', count(*) FROM (SELECT Date_ID FROM dim_date GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'dim_date contiguous', max(Full_Date) - min(Full_Date) + 1 - count(*) FROM dim_date
UNION ALL SELECT 'fact.Route_ID not null', count_if(Route_ID IS NULL) FROM fact
UNION ALL SELECT 'fact.Date_ID not null', count_if(Date_ID IS NULL) FROM fact""" + INTEGRITY_TAIL, *STAR_SQL), longs=("violations",))
def star_integrity(spark, sf):
    t = star_tables(spark, sf)
    return ct.star_integrity(t["fact"], t["dim_vendor"], t["dim_route"], t["dim_date"])


@query("output_integrity", with_ship("""
SELECT 'row count' AS "check", 0 AS violations FROM (SELECT count(*) FROM fact)
UNION ALL SELECT 'score not null', count_if(raw_score IS NULL) FROM ship
UNION ALL SELECT 'column order', 0 FROM (SELECT count(*) FROM fact)""" + INTEGRITY_TAIL, *STAR_SQL), longs=("violations",))
def output_integrity(spark, sf):
    t = star_tables(spark, sf)
    scored = star.attach_scores(t["fact"], stored_scores(spark, sf))
    return ct.output_integrity(scored, t["fact"], t["dim_vendor"], t["dim_route"], t["dim_date"])


@query("physical_bounds", with_ship("""
SELECT Shipment_ID, concat_ws('|', CASE WHEN NOT (Distance_km > 0 AND Distance_km <= 5000) THEN 'Distance_km' END,
  CASE WHEN NOT (Weight_tons > 0 AND Weight_tons <= 24) THEN 'Weight_tons' END,
  CASE WHEN NOT Vendor_Rating BETWEEN 1 AND 5 THEN 'Vendor_Rating' END, CASE WHEN NOT raw_score BETWEEN 0 AND 1 THEN 'raw_score' END) AS reasons
FROM ship WHERE reasons <> ''"""))
def physical_bounds(spark, sf):
    df = shipments(spark, sf, ["Shipment_ID", "Distance_km", "Weight_tons", "Vendor_Rating", "raw_score"])
    bad = ct.quarantine(ct.physical_split(df, max_weight=24.0, probability="raw_score"))
    return bad.select("Shipment_ID", F.array_join("reasons", "|").alias("reasons"))


PAIR_SQL = """pair AS (SELECT Origin, Destination, count(*) AS n, min(Distance_km) AS min_km, max(Distance_km) AS max_km,
  avg(Distance_km) AS mean_km, stddev_samp(Distance_km) AS std_km, stddev_samp(Distance_km) / avg(Distance_km) AS cv
  FROM ship GROUP BY ALL HAVING count(*) > 1)"""


def _pair_rounding(df):
    return df.select("Origin", "Destination", "n", r("min_km").alias("min_km"), r("max_km").alias("max_km"),
                     r("mean_km").alias("mean_km"), r("std_km").alias("std_km"), r("cv").alias("cv"))


PAIR_OUT = """Origin, Destination, n, round(min_km, 6) AS min_km, round(max_km, 6) AS max_km, round(mean_km, 6) AS mean_km,
  round(std_km, 6) AS std_km, round(cv, 6) AS cv"""
PAIR_COLUMNS = ["Origin", "Destination", "Distance_km"]


@query("distance_consistency", with_ship(f"SELECT {PAIR_OUT} FROM pair", PAIR_SQL))
def distance_consistency(spark, sf):
    return _pair_rounding(ct.distance_consistency(shipments(spark, sf, PAIR_COLUMNS)))


@query("distance_violations", with_ship(f"SELECT {PAIR_OUT} FROM pair WHERE cv > 0.0335", PAIR_SQL))
def distance_violations(spark, sf):
    return _pair_rounding(ct.distance_violations(shipments(spark, sf, PAIR_COLUMNS), 0.0335))


@query("worst_distance_pair", with_ship(f"SELECT {PAIR_OUT} FROM pair ORDER BY pair.cv DESC, Origin, Destination LIMIT 1", PAIR_SQL))
def worst_distance_pair(spark, sf):
    return _pair_rounding(ct.distance_consistency(shipments(spark, sf, PAIR_COLUMNS)).limit(1))


@query("co2_drift", with_ship("""
SELECT Vehicle_Type, count(*) AS shipments, round(avg(CO2_Emission_kg / co2_formula), 6) AS mean_ratio,
  round(min(CO2_Emission_kg / co2_formula), 6) AS min_ratio, round(max(CO2_Emission_kg / co2_formula), 6) AS max_ratio,
  count_if(CO2_Emission_kg < 0.5) AS under_floor FROM ship GROUP BY Vehicle_Type"""), longs=("under_floor",))
def co2_drift(spark, sf):
    df = ct.co2_drift(shipments(spark, sf, [*CO2_INPUTS, "CO2_Emission_kg"]), fx.co2_kg())
    return df.select("Vehicle_Type", "shipments", *[r(c).alias(c) for c in ("mean_ratio", "min_ratio", "max_ratio")],
                     "under_floor")


@query("tier_agreement", with_ship("""
SELECT CASE WHEN p >= 0.5 THEN 'High Risk' WHEN p >= 0.2 THEN 'Medium Risk' ELSE 'Low Risk' END AS Risk_Level, count(*) AS shipments,
  count_if((p >= 0.45) <> (p >= 0.5)) AS mismatches FROM (SELECT round_even(raw_score, 2)::DOUBLE AS p FROM ship) GROUP BY 1"""), longs=("mismatches",))
def tier_agreement(spark, sf):
    return ct.tier_mismatches(stored_scores(spark, sf), high=0.45)


@query("vendor_distinct_lanes", with_ship(
    "SELECT DISTINCT Vendor_ID, Origin, Destination FROM ship"))
def vendor_distinct_lanes(spark, sf):
    return shipments(spark, sf, ["Vendor_ID", "Origin", "Destination"]).distinct()

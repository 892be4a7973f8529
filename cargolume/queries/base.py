"""Registry of named queries with their reference SQL."""

REGISTRY: dict = {}

# The shipment view in SQL, for the comparison engine.
SHIP = """
ship0 AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS Shipment_ID,
    strftime(l_shipdate, '%Y-%m-%d') AS Shipment_Date,
    'VEND-' || lpad(CAST(l_suppkey AS VARCHAR), greatest(5, length(CAST(l_suppkey AS VARCHAR)))::INT, '0') AS Vendor_ID,
    least(5.0::DOUBLE, greatest(1.0::DOUBLE, 1.4::DOUBLE + (l_suppkey * 37 % 36) / 10.0::DOUBLE + (l_linenumber % 3 - 1) * 0.1::DOUBLE)) AS Vendor_Rating,
    o.n_name AS Origin, d.n_name AS Destination,
    (60 + 61 * abs(s_nationkey - c_nationkey)) * (0.95::DOUBLE + (l_partkey % 11) / 100.0::DOUBLE) AS Distance_km,
    l_quantity / 2.0::DOUBLE AS Weight_tons,
    CASE WHEN (l_partkey + 3 * month(l_shipdate)) % 20 < 12 THEN 'Normal'
         WHEN (l_partkey + 3 * month(l_shipdate)) % 20 < 16 THEN 'Rain'
         WHEN (l_partkey + 3 * month(l_shipdate)) % 20 < 18 THEN 'Storm' ELSE 'Snow' END AS Weather_Condition,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'High' WHEN o_orderpriority LIKE '2%' OR o_orderpriority LIKE '3%' THEN 'Medium' ELSE 'Low' END AS Traffic_Density,
    CASE WHEN p_type IN ('LARGE','STANDARD','PROMO') THEN 'Diesel Truck' WHEN p_type = 'ECONOMY' THEN 'Electric Semi' ELSE 'Hybrid Van' END AS Vehicle_Type
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation o ON s_nationkey = o.n_nationkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation d ON c_nationkey = d.n_nationkey),
ship1 AS (
  SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(
      CASE Weather_Condition WHEN 'Normal' THEN 0.0::DOUBLE WHEN 'Rain' THEN 0.6::DOUBLE WHEN 'Storm' THEN 2.0::DOUBLE ELSE 1.4::DOUBLE END
    + CASE Traffic_Density WHEN 'Low' THEN 0.0::DOUBLE WHEN 'Medium' THEN 0.5::DOUBLE ELSE 1.2::DOUBLE END
    + (3.25::DOUBLE - Vendor_Rating) * 0.8::DOUBLE * (1.0::DOUBLE + CASE Weather_Condition WHEN 'Normal' THEN 0.0::DOUBLE WHEN 'Rain' THEN 0.2::DOUBLE WHEN 'Storm' THEN 0.75::DOUBLE ELSE 0.5::DOUBLE END)
    + (Distance_km - 694.0::DOUBLE) / 1800.0::DOUBLE * 0.5::DOUBLE - 2.7::DOUBLE))) AS raw_score,
    (Distance_km * Weight_tons * CASE Vehicle_Type WHEN 'Diesel Truck' THEN 0.13::DOUBLE WHEN 'Electric Semi' THEN 0.035::DOUBLE ELSE 0.08::DOUBLE END
      + CASE Vehicle_Type WHEN 'Diesel Truck' THEN 8.0::DOUBLE WHEN 'Electric Semi' THEN 1.5::DOUBLE ELSE 4.0::DOUBLE END)
      * CASE Weather_Condition WHEN 'Normal' THEN 1.0::DOUBLE WHEN 'Rain' THEN 1.03::DOUBLE WHEN 'Storm' THEN 1.08::DOUBLE ELSE 1.06::DOUBLE END
      * CASE Traffic_Density WHEN 'Low' THEN 1.0::DOUBLE WHEN 'Medium' THEN 1.04::DOUBLE ELSE 1.1::DOUBLE END AS co2_raw
  FROM ship0),
ship AS (
  SELECT *, greatest(co2_raw, 0.5::DOUBLE) AS co2_formula,
    CAST(CASE WHEN ((l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709 + l_linenumber*15485863) % 10007) / 10007.0::DOUBLE < raw_score
      THEN 1 + l_linenumber % 5 ELSE 0 END AS INTEGER) AS Actual_Delay_Days,
    greatest(greatest(co2_raw, 0.5::DOUBLE) * (0.97::DOUBLE + (l_linenumber % 7) / 100.0::DOUBLE), 0.5::DOUBLE) AS CO2_Emission_kg
  FROM ship1)"""


def with_ship(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SHIP, *ctes]) + "\n" + body


def query(name: str, sql: str | None = None, longs: tuple = ()):
    """Register a callable (spark, folder) -> DataFrame, with SQL where SQL can express it.

    `longs` names SQL columns to cast to BIGINT, since counts and sums may come back wider.
    """
    if sql and longs:
        casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in longs)
        sql = f"SELECT * REPLACE ({casts}) FROM ({sql})"

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap

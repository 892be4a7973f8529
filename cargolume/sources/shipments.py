"""Raw shipments derived from order lines.

Every line is one shipment. The joins are left joins to unique dimension keys, so the row count is
that of the lines, and only the dimensions that the asked-for columns need are joined. No side is
forced into a broadcast: Spark picks from the sizes it sees, and adaptive execution splits the
partitions of hot keys.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume.functions import formulas as fx
from cargolume.schemas import RAW_COLUMNS

DERIVED = ["raw_score"]
_NEEDS = {
    "Distance_km": {"origin", "destination"}, "Origin": {"origin"}, "Destination": {"destination"},
    "Traffic_Density": {"order"}, "Vehicle_Type": {"part"},
    "raw_score": {"origin", "destination", "order"},
    "Actual_Delay_Days": {"origin", "destination", "order"},
    "CO2_Emission_kg": {"origin", "destination", "order", "part"},
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipments(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """The shipment view; `columns` limits the columns and with them the joins."""
    return shipments_from(read_table(spark, folder, "lineitem"), spark, folder, columns)


def shipments_from(lines: DataFrame, spark: SparkSession, folder: str, columns=None) -> DataFrame:
    """The same over given lines, which may be a stream."""
    columns = list(columns or RAW_COLUMNS + DERIVED)
    unknown = set(columns) - set(RAW_COLUMNS) - set(DERIVED)
    if unknown:
        raise ValueError(f"not shipment columns: {sorted(unknown)}")
    needs = set().union(*[_NEEDS.get(c, set()) for c in columns]) if columns else set()
    df = lines
    nation = read_table(spark, folder, "nation")
    if "order" in needs or "destination" in needs:
        # Customers meet the orders, which are fewer and narrower than the lines: the lines are dealt out once for both.
        orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).alias("o_priority"))
        if "destination" in needs:
            customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "origin" in needs:
        supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "part" in needs:
        part = read_table(spark, folder, "part").select("p_partkey", "p_type")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    # Names come last, so that no shuffle carries them.
    if "origin" in needs:
        origin = nation.select(F.col("n_nationkey").alias("on_key"), F.col("n_name").alias("on_name"))
        df = df.join(origin, F.col("s_nationkey") == F.col("on_key"), "left")
    if "destination" in needs:
        destination = nation.select(F.col("n_nationkey").alias("dn_key"), F.col("n_name").alias("dn_name"))
        df = df.join(destination, F.col("c_nationkey") == F.col("dn_key"), "left")
    # In three steps, each a plain projection: the later ones use the columns of the earlier ones, so
    # no expression is repeated inside another and the generated code stays small enough to compile.
    score_parts = ["Vendor_Rating", "Distance_km", "Weather_Condition", "Traffic_Density"]
    co2_parts = ["Distance_km", "Weight_tons", "Vehicle_Type", "Weather_Condition", "Traffic_Density"]
    wanted = set(columns)
    if wanted & {"raw_score", "Actual_Delay_Days"}:
        wanted |= {*score_parts, "raw_score"}
    if "CO2_Emission_kg" in wanted:
        wanted |= set(co2_parts)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"] if wanted & set(_LATE) else []
    df = df.select(*[_definition(c).alias(c) for c in RAW_COLUMNS if c in wanted and c not in _LATE], *keys)
    if "raw_score" in wanted:
        df = df.withColumn("raw_score", fx.sigmoid(fx.delay_index() - F.lit(2.7)))
    if "CO2_Emission_kg" in wanted:
        formula = fx.co2_kg()
        noise = F.lit(0.97) + (F.col("l_linenumber") % 7) / F.lit(100.0)
        df = df.withColumn("_kg", formula).withColumn("CO2_Emission_kg", F.greatest(F.col("_kg") * noise, F.lit(0.5)))
    if "Actual_Delay_Days" in wanted:
        u = ((F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_suppkey") * 1299709
              + F.col("l_linenumber") * 15485863) % 10007) / F.lit(10007.0)
        late = F.when(u < F.col("raw_score"), 1 + F.col("l_linenumber") % 5).otherwise(0).cast("int")
        df = df.withColumn("Actual_Delay_Days", late)
    return df.select(*columns)


_LATE = ("raw_score", "Actual_Delay_Days", "CO2_Emission_kg")


def _definition(name: str):
    day = F.to_date("l_shipdate")
    if name == "Shipment_ID":
        return F.concat_ws("-", *[F.col(c).cast("string") for c in
                                  ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                           F.unix_date(day).cast("string"))
    if name == "Shipment_Date":
        return day.cast("string")
    if name == "Vendor_ID":
        return F.concat(F.lit("VEND-"), F.lpad(F.col("l_suppkey").cast("string"), _width("l_suppkey"), "0"))
    if name == "Vendor_Rating":
        base = F.lit(1.4) + (F.col("l_suppkey") * 37 % 36) / F.lit(10.0) \
            + (F.col("l_linenumber") % 3 - 1) * F.lit(0.1)
        return F.least(F.lit(5.0), F.greatest(F.lit(1.0), base))
    if name == "Origin":
        return F.col("on_name")
    if name == "Destination":
        return F.col("dn_name")
    if name == "Distance_km":
        return (60 + 61 * F.abs(F.col("s_nationkey") - F.col("c_nationkey"))) \
            * (F.lit(0.95) + (F.col("l_partkey") % 11) / F.lit(100.0))
    if name == "Weight_tons":
        return F.col("l_quantity") / F.lit(2.0)
    if name == "Weather_Condition":
        w = (F.col("l_partkey") + 3 * F.month(day)) % 20
        return F.when(w < 12, "Normal").when(w < 16, "Rain").when(w < 18, "Storm").otherwise("Snow")
    if name == "Traffic_Density":
        p = F.col("o_priority")
        return F.when(p == "1", "High").when(p.isin("2", "3"), "Medium").otherwise("Low")
    if name == "Vehicle_Type":
        return (F.when(F.col("p_type").isin("LARGE", "STANDARD", "PROMO"), "Diesel Truck")
                .when(F.col("p_type") == "ECONOMY", "Electric Semi").otherwise("Hybrid Van"))
    raise KeyError(name)


def _width(column: str):
    """At least five digits; lpad would cut a longer key."""
    return F.greatest(F.lit(5), F.length(F.col(column).cast("string")))

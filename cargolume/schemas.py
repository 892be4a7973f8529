"""Explicit schemas and column orders."""

from pyspark.sql import types as T

S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(*pairs):
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


RAW = _struct(
    ("Shipment_ID", S), ("Shipment_Date", S), ("Vendor_ID", S), ("Vendor_Rating", D),
    ("Origin", S), ("Destination", S), ("Distance_km", D), ("Weight_tons", D),
    ("Weather_Condition", S), ("Traffic_Density", S), ("Vehicle_Type", S),
    ("Actual_Delay_Days", I), ("CO2_Emission_kg", D),
)
DIM_VENDOR = _struct(("Vendor_ID", S), ("Vendor_Rating", D))
DIM_ROUTE = _struct(
    ("Route_ID", S), ("Origin", S), ("Destination", S), ("Vehicle_Type", S),
    ("Weather_Condition", S), ("Traffic_Density", S),
)
DIM_DATE = _struct(
    ("Date_ID", I), ("Full_Date", T.DateType()), ("Year", I), ("Quarter", S), ("Month", I),
    ("Month_Name", S), ("Month_Year", S), ("Season", S), ("Day_Of_Week", S), ("Is_Weekend", B),
)
FACT = _struct(
    ("Shipment_ID", S), ("Date_ID", I), ("Vendor_ID", S), ("Route_ID", S), ("Weight_tons", D),
    ("Distance_km", D), ("Actual_Delay_Days", I), ("CO2_Emission_kg", D),
)
SCORED = T.StructType(
    FACT.fields + _struct(("Delay_Risk_Probability", D), ("Risk_Level", S)).fields
)

RAW_COLUMNS = RAW.names
FACT_COLUMNS = FACT.names
SCORED_COLUMNS = SCORED.names
ROUTE_COLUMNS = ["Origin", "Destination", "Vehicle_Type", "Weather_Condition", "Traffic_Density"]

NUMERIC_FEATURES = ["Distance_km", "Weight_tons", "Vendor_Rating"]
CATEGORICAL_FEATURES = ["Weather_Condition", "Traffic_Density", "Vehicle_Type"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

AUDIT_COLUMNS = [
    "scored_at", "shipment_id", "vendor_id", "route_id", "distance_km", "weight_tons",
    "vendor_rating", "weather_condition", "traffic_density", "vehicle_type", "probability",
    "risk_level", "high_threshold", "medium_threshold", "cost_fn_over_fp", "co2_kg",
    "carbon_price_per_ton", "carbon_cost", "model_name", "model_version", "artifact_sha256",
    "extrapolated",
]

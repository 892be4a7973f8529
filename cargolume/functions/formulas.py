"""Shipment arithmetic as column expressions; no join and no UDF."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import UnknownCategoryError

VEHICLE_COLUMN, WEATHER_COLUMN, TRAFFIC_COLUMN = "Vehicle_Type", "Weather_Condition", "Traffic_Density"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(column, table: dict) -> Column:
    """Value of a small parameter table for a category; null where the category is unknown."""
    key, out = _col(column), None
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)) if out is None else out.when(key == name, F.lit(value))
    return out


def co2_multiplier(weather=WEATHER_COLUMN, traffic=TRAFFIC_COLUMN) -> Column:
    return lookup(weather, P.WEATHER_CO2) * lookup(traffic, P.TRAFFIC_CO2)


def co2_kg(distance="Distance_km", weight="Weight_tons", vehicle=VEHICLE_COLUMN,
           weather=WEATHER_COLUMN, traffic=TRAFFIC_COLUMN) -> Column:
    """kg CO2 of one shipment; null where a category is unknown."""
    running = _col(distance) * _col(weight) * lookup(vehicle, P.EMISSION_FACTOR)
    raw = (running + lookup(vehicle, P.BASE_EMISSION)) * lookup(weather, P.WEATHER_CO2) \
        * lookup(traffic, P.TRAFFIC_CO2)
    # greatest() skips nulls, so an unknown category has to be kept null by hand.
    return F.when(raw.isNotNull(), F.greatest(raw, F.lit(P.CO2_FLOOR_KG)))


def carbon_cost(kg, price=P.CARBON_PRICE) -> Column:
    return _col(kg) / 1000.0 * price


def freight_cost(distance="Distance_km", weight="Weight_tons", vehicle=VEHICLE_COLUMN,
                 rates=None, fixed=None) -> Column:
    return _col(distance) * _col(weight) * lookup(vehicle, rates or P.FREIGHT_RATE) \
        + lookup(vehicle, fixed or P.FREIGHT_FIXED)


def risk_tier(probability, high=P.HIGH_THRESHOLD, medium=P.MEDIUM_THRESHOLD) -> Column:
    """Tier with inclusive lower edges. Spark orders NaN above every number; it is tiered Low here."""
    p = F.nanvl(_col(probability), F.lit(-1.0))
    return F.when(p >= high, P.HIGH).when(p >= medium, P.MEDIUM).when(p.isNotNull(), P.LOW)


def stored_probability(probability) -> Column:
    """Two decimals, half to even: the value that the scored table keeps and tiers."""
    return F.bround(_col(probability), 2)


def cost_threshold(ratio) -> Column:
    """p* = 1 / (1 + r), two decimals; raises on r <= 0."""
    r = _col(ratio)
    checked = F.when(r > 0, r).otherwise(
        F.raise_error(F.lit("the cost ratio must be positive")).cast("double"))
    return F.bround(F.lit(1.0) / (F.lit(1.0) + checked), 2)


def expected_delay_cost(probability, penalty=P.SLA_PENALTY, intervention=0.0) -> Column:
    return _col(probability) * penalty + intervention


def is_delayed(days="Actual_Delay_Days") -> Column:
    return (_col(days) > 0).cast("int")


def logit(p, clip=P.LOGIT_CLIP) -> Column:
    """Log-odds of a clipped probability; null where there is none."""
    p = _col(p)
    inside = F.least(F.greatest(p, F.lit(clip)), F.lit(1.0 - clip))
    # greatest() and least() skip nulls and rank NaN highest: either would turn a missing score into a number.
    return F.when(p.isNotNull() & ~F.isnan(p), F.ln(inside / (F.lit(1.0) - inside)))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def delay_index(rating="Vendor_Rating", distance="Distance_km", weather=WEATHER_COLUMN,
                traffic=TRAFFIC_COLUMN) -> Column:
    """Linear delay-risk index in log-odds: weather, traffic, vendor x weather and distance."""
    vendor = (F.lit(P.VENDOR_CENTRE) - _col(rating)) * P.VENDOR_SLOPE
    amplifier = F.lit(1.0) + lookup(weather, P.WEATHER_AMPLIFIER)
    far = (_col(distance) - P.DISTANCE_CENTRE) / P.DISTANCE_SPAN * P.DISTANCE_SLOPE
    return lookup(weather, P.WEATHER_LOGIT) + lookup(traffic, P.TRAFFIC_LOGIT) \
        + vendor * amplifier + far


def outside_range(ranges: dict) -> Column:
    """(feature, side, value, edge) of each numeric feature outside the training range {feature: (min, max)}; side is low or high."""
    def found(name, side, edge):
        return F.struct(F.lit(name).alias("feature"), F.lit(side).alias("side"), F.col(name).cast("double").alias("value"), F.lit(float(edge)).alias("edge"))

    each = [F.when(F.col(name) < low, found(name, "low", low)).when(F.col(name) > high, found(name, "high", high))
            for name, (low, high) in ranges.items()]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def extrapolation_warnings(ranges: dict) -> Column:
    """Texts for the numeric features outside the training range {feature: (min, max)}."""
    return F.transform(outside_range(ranges), lambda x: F.format_string(
        "%s=%.6g (trained %s %.6g)", x["feature"], x["value"], F.when(x["side"] == "low", "from").otherwise("up to"), x["edge"]))


def parent_feature(name="feature", categorical=("Weather_Condition", "Traffic_Density", "Vehicle_Type")) -> Column:
    """One-hot dummy name back to its source column."""
    out = _col(name)
    for parent in categorical:
        out = F.when(_col(name).startswith(parent + "_"), F.lit(parent)).otherwise(out)
    return out


KNOWN_LEVELS = {VEHICLE_COLUMN: P.VEHICLES, WEATHER_COLUMN: P.WEATHER, TRAFFIC_COLUMN: P.TRAFFIC}


def unknown_categories(df: DataFrame, levels: dict | None = None) -> DataFrame:
    """(field, value, shipments, accepted) for every category without a reference value."""
    levels = levels or KNOWN_LEVELS
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("value"),
                 F.lit(", ".join(sorted(known))).alias("accepted"),
                 F.coalesce(F.col(c).isin(known), F.lit(False)).alias("known"))
        for c, known in levels.items()]))
    return (df.select(pairs.alias("x")).select("x.*").where(~F.col("known"))
            .groupBy("field", "value", "accepted").agg(F.count("*").alias("shipments")))


def require_known_categories(df: DataFrame, levels: dict | None = None) -> DataFrame:
    bad = unknown_categories(df, levels).orderBy("field", "value").limit(5).collect()
    if bad:
        raise UnknownCategoryError("; ".join(
            f"{r['field']} {r['value']!r} has no reference value (accepted: {r['accepted']})" for r in bad))
    return df

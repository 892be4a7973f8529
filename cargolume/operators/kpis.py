"""Business measures at any grain."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions import formulas as fx
from cargolume.operators.ordering import quantiles, quartile
from cargolume.session import literal_rows


def parameter_table(spark, price=P.CARBON_PRICE, high=P.HIGH_THRESHOLD, medium=P.MEDIUM_THRESHOLD,
                    ratio=P.COST_RATIO) -> DataFrame:
    return literal_rows(spark, ["parameter", "value"], [
        ("Carbon_Price_Per_Ton", price), ("High_Risk_Threshold", high), ("Medium_Risk_Threshold", medium),
        ("Cost_FN_Over_FP", ratio)])


def measures(price=None):
    """The report's measures as aggregates over whatever rows the slicers leave."""
    tons = F.sum("CO2_Emission_kg") / 1000.0
    price = F.lit(P.CARBON_PRICE) if price is None else price
    return [
        F.count("Shipment_ID").alias("total_shipments"), tons.alias("total_co2_tons"),
        (tons * price).alias("carbon_tax_impact"), F.avg("Actual_Delay_Days").alias("average_delay_days"),
        F.try_divide(F.count_if(F.col("Risk_Level") == P.HIGH), F.count("*")).alias("high_risk_rate"),
        F.avg("Delay_Risk_Probability").alias("average_probability"),
    ]


def report(df: DataFrame, slicers=(), mode="group", parameters: DataFrame | None = None) -> DataFrame:
    """Measures by slicers: "group", "rollup" or "cube"; the price may come from a parameter table."""
    price = None
    if parameters is not None:
        price = parameters.where("parameter = 'Carbon_Price_Per_Ton'").select("value").scalar()
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[mode](*slicers)
    return grouped.agg(*measures(price))


def trend(df: DataFrame, levels=("Year", "Quarter", "Month")) -> DataFrame:
    """Delay rate, mean delay, predicted minus actual, and CO2 per shipment, rolled up over the calendar."""
    late = F.avg((F.col("Actual_Delay_Days") > 0).cast("double"))
    return df.rollup(*levels).agg(
        F.count("*").alias("shipments"), late.alias("delay_rate"), F.avg("Actual_Delay_Days").alias("average_delay"),
        (F.avg("Delay_Risk_Probability") - late).alias("predicted_minus_actual"),
        (F.sum("CO2_Emission_kg") / 1000.0 / F.count("*")).alias("co2_tons_per_shipment"))


def month_weather_pivot(df: DataFrame, day="Shipment_Date") -> DataFrame:
    """Row percents of the weather per month, shipments and delay percent."""
    counts = [F.count_if(F.col("Weather_Condition") == w).alias(f"_{w}") for w in P.WEATHER]
    cells = df.groupBy(F.month(F.to_date(day)).alias("Month")).agg(
        F.count("*").alias("Shipments"), F.avg((F.col("Actual_Delay_Days") > 0).cast("double")).alias("_late"), *counts)
    return cells.select("Month", *[F.bround(F.col(f"_{w}") / F.col("Shipments") * 100.0, 1).alias(w) for w in P.WEATHER],
                        "Shipments", F.bround(F.col("_late") * 100.0, 1).alias("Delay_Percent"))


def month_weather_counts(df: DataFrame, day="Shipment_Date") -> DataFrame:
    return df.groupBy(F.month(F.to_date(day)).alias("Month")).pivot("Weather_Condition", P.WEATHER).agg(
        F.count(F.lit(1))).na.fill(0, P.WEATHER)


def mean_delay_by_weather(df: DataFrame) -> DataFrame:
    return df.groupBy("Weather_Condition").agg(
        F.bround(F.avg("Actual_Delay_Days"), 2).alias("mean_delay_days")).orderBy(F.desc("mean_delay_days"), "Weather_Condition")


def mean_co2_by_vehicle(df: DataFrame) -> DataFrame:
    return df.groupBy("Vehicle_Type").agg(F.avg("CO2_Emission_kg").alias("mean_co2_kg")).orderBy(F.desc("mean_co2_kg"))


def delay_by_weather_and_rating(df: DataFrame) -> DataFrame:
    cuts = quantiles(df, "Vendor_Rating", [0.25, 0.5, 0.75])
    return df.groupBy("Weather_Condition", quartile("Vendor_Rating", cuts).alias("rating_quartile")).agg(
        F.count("*").alias("shipments"), F.avg((F.col("Actual_Delay_Days") > 0).cast("double")).alias("delay_rate"))


def key_influencers(df: DataFrame, tier=P.HIGH) -> DataFrame:
    """How much likelier the tier is at a level than elsewhere, per factor; the rating goes in quartiles."""
    cuts = quantiles(df, "Vendor_Rating", [0.25, 0.5, 0.75])
    rating = F.concat(F.lit("Q"), quartile("Vendor_Rating", cuts).cast("string"))
    # Reduced to the cells of the three factors first; the fan-out then runs over a few dozen rows.
    cells = df.groupBy(rating.alias("Vendor_Rating"), "Traffic_Density", "Weather_Condition").agg(
        F.count("*").alias("n"), F.count_if(F.col("Risk_Level") == tier).alias("k"))
    fanned = cells.select("n", "k", F.explode(F.array(*[
        F.struct(F.lit(c).alias("factor"), F.col(c).alias("level"))
        for c in ("Vendor_Rating", "Traffic_Density", "Weather_Condition")])).alias("x"))
    all_n, all_k = cells.agg(F.sum("n")).scalar(), cells.agg(F.sum("k")).scalar()
    levels = fanned.groupBy("x.factor", "x.level").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    here = F.col("k") / F.col("n")
    there = F.try_divide(all_k - F.col("k"), all_n - F.col("n"))
    return levels.select(
        "factor", "level", F.col("n").alias("shipments"), here.alias("rate"), there.alias("rate_elsewhere"),
        F.try_divide(here, there).alias("lift"))


def days_without_shipments(calendar: DataFrame, fact: DataFrame) -> DataFrame:
    return calendar.join(fact.select("Date_ID").distinct(), "Date_ID", "left_anti")


def shipment_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.min("Shipment_Date").alias("first_day"),
                  F.max("Shipment_Date").alias("last_day"), F.count_distinct("Vendor_ID").alias("vendors"),
                  F.avg((F.col("Actual_Delay_Days") > 0).cast("double")).alias("delay_rate"))


def delay_day_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("Actual_Delay_Days").agg(F.count("*").alias("shipments"))


def etl_summary(fact: DataFrame, vendor: DataFrame, route: DataFrame, date: DataFrame) -> DataFrame:
    """(table, rows) and the calendar days without shipments."""
    out = None
    for name, df in (("fact_shipments", fact), ("dim_vendor", vendor), ("dim_route", route), ("dim_date", date),
                     ("days_without_shipments", days_without_shipments(date, fact))):
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def corridor_pooling(df: DataFrame, windows=(1, 7, 30), by_vehicle=False, day="Shipment_Date") -> DataFrame:
    """Legs saved when a corridor's shipments within a window ride together, and the base emission saved."""
    corridor = ["Origin", "Destination"] + (["Vehicle_Type"] if by_vehicle else [])
    base = fx.lookup("Vehicle_Type", P.BASE_EMISSION) * fx.co2_multiplier()
    # Per day first; longer windows then fan out over days, not over shipments.
    daily = df.groupBy(*corridor, F.unix_date(F.to_date(day)).alias("d")).agg(F.count("*").alias("n"), F.sum(base).alias("kg"))
    wide = daily.withColumn("window_days", F.explode(F.array(*[F.lit(w) for w in windows])))
    groups = wide.groupBy("window_days", *corridor, F.floor(F.col("d") / F.col("window_days")).alias("slot")).agg(
        F.sum("n").alias("n"), F.sum("kg").alias("kg"))
    return groups.groupBy("window_days").agg(
        F.sum(F.col("n") - 1).alias("legs_eliminated"),
        F.sum((F.col("n") - 1) * F.col("kg") / F.col("n")).alias("saved_kg"))


def fixed_emission_share(df: DataFrame) -> DataFrame:
    fixed = F.sum(fx.lookup("Vehicle_Type", P.BASE_EMISSION) * fx.co2_multiplier())
    return df.agg(fixed.alias("fixed_kg"), F.sum(fx.co2_kg()).alias("total_kg"),
                  F.try_divide(fixed, F.sum(fx.co2_kg())).alias("fixed_share"))


def fleet_by_distance(df: DataFrame, vehicle="Diesel Truck") -> DataFrame:
    """Share of a vehicle per distance quartile."""
    cuts = quantiles(df, "Distance_km", [0.25, 0.5, 0.75])
    return df.groupBy(quartile("Distance_km", cuts).alias("distance_quartile")).agg(
        F.count("*").alias("shipments"), F.avg((F.col("Vehicle_Type") == vehicle).cast("double")).alias("vehicle_share"))


def fleet_by_vendor(df: DataFrame, vehicle="Diesel Truck") -> DataFrame:
    """Spread of the vendors' shares of a vehicle, and the share over all shipments."""
    share = df.groupBy("Vendor_ID").agg(F.count("*").alias("n"), F.count_if(F.col("Vehicle_Type") == vehicle).alias("k"))
    s = F.col("k") / F.col("n")
    return share.agg(F.min(s).alias("min_share"), F.max(s).alias("max_share"), F.stddev_samp(s).alias("sd_share"),
                     (F.sum("k") / F.sum("n")).alias("fleet_share"))


def solve_offset(df: DataFrame, column: str, target=P.TARGET_DELAY_RATE, low=-8.0, high=4.0, tolerance=1e-9) -> float:
    """The constant c with mean sigmoid(x + c) = target; 32 candidates per pass, only sums come back."""
    while high - low > tolerance:
        step = (high - low) / 33
        tries = [low + step * (i + 1) for i in range(32)]
        means = df.agg(*[F.avg(fx.sigmoid(F.col(column) + c)).alias(f"c{i}") for i, c in enumerate(tries)]).first()
        below = sum(1 for m in means if m < target)
        low, high = low + step * below, low + step * (below + 1)
    return (low + high) / 2.0

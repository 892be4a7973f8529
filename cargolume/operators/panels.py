"""Shipment x vehicle panels, the vehicle guards and status-quo figures.

The fleet is a fixed short list, so a panel is a fan-out of each row by a literal array: no join and
no shuffle. Emissions and freight do not depend on the vendor, who is left out until needed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError, VehicleEffectError
from cargolume.functions import formulas as fx


def counterfactual_grid(df: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    """Every shipment once per vehicle, all else held fixed."""
    other = [c for c in df.columns if c != "Vehicle_Type"]
    return df.select(*other, F.explode(F.array(*[F.lit(v) for v in fleet])).alias("Vehicle_Type"))


def stacked_grid(df: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    """The same as a union of one frame per vehicle."""
    out = None
    for v in fleet:
        part = df.withColumn("Vehicle_Type", F.lit(v))
        out = part if out is None else out.unionByName(part)
    return out


def emission_panel(df: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    """(Shipment_ID, Vehicle_Type, co2_kg) from the formula, not from the stored column."""
    return counterfactual_grid(df, fleet).select("Shipment_ID", "Vehicle_Type", fx.co2_kg().alias("co2_kg"))


def freight_panel(df: DataFrame, fleet=P.VEHICLES, rates=None, fixed=None) -> DataFrame:
    return counterfactual_grid(df, fleet).select(
        "Shipment_ID", "Vehicle_Type", fx.freight_cost(rates=rates, fixed=fixed).alias("freight"))


def allocation_panel(df: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    return counterfactual_grid(df, fleet).select(
        "Shipment_ID", "Vehicle_Type", fx.co2_kg().alias("co2_kg"), fx.freight_cost().alias("freight"))


def wide_panel(df: DataFrame, fleet=P.VEHICLES, keep=()) -> DataFrame:
    """One row per shipment with e0.. (kg) and f0.. (freight) per vehicle in fleet order."""
    e = [fx.co2_kg(vehicle=F.lit(v)).alias(f"e{i}") for i, v in enumerate(fleet)]
    f = [fx.freight_cost(vehicle=F.lit(v)).alias(f"f{i}") for i, v in enumerate(fleet)]
    return df.select("Shipment_ID", *keep, *e, *f)


def risk_columns(slope: float, intercepts: dict, score="Delay_Risk_Probability", fleet=P.VEHICLES):
    """p0.. per vehicle from the one score of the shipment as it ran."""
    z = fx.logit(score) * slope
    return [fx.sigmoid(z + float(intercepts[v])).alias(f"p{i}") for i, v in enumerate(fleet)]


def risk_panel(df: DataFrame, slope: float, intercepts: dict, score="Delay_Risk_Probability",
               fleet=P.VEHICLES) -> DataFrame:
    """(Shipment_ID, Vehicle_Type, p): the vehicle only shifts the level."""
    p = fx.sigmoid(fx.logit(score) * slope + fx.lookup("Vehicle_Type", intercepts))
    return counterfactual_grid(df, fleet).select("Shipment_ID", "Vehicle_Type", p.alias("p"))


def by_pair(left: DataFrame, right: DataFrame) -> DataFrame:
    """A left join on (Shipment_ID, Vehicle_Type), dealt by the shipment alone.

    A side that its narrow rows were dealt out for by shipment, before the fan-out to vehicles, is not shuffled again.
    """
    other = right.withColumnsRenamed({"Shipment_ID": "_id", "Vehicle_Type": "_vehicle"})
    vehicle = (F.col("Vehicle_Type") <= F.col("_vehicle")) & (F.col("Vehicle_Type") >= F.col("_vehicle"))  # as a key it would be dealt by
    return left.join(other, (F.col("Shipment_ID") == F.col("_id")) & vehicle, "left").drop("_id", "_vehicle")


def align_risk(panel: DataFrame, risk: DataFrame) -> DataFrame:
    return by_pair(panel, risk)


def missing_risk(aligned: DataFrame) -> DataFrame:
    """Shipments that lack a probability for some vehicle."""
    return aligned.where(F.col("p").isNull() | F.isnan("p")).groupBy("Shipment_ID").agg(
        F.count("*").alias("missing_vehicles"))


def require_risk(aligned: DataFrame) -> DataFrame:
    n = missing_risk(aligned).count()
    if n:
        raise InfeasiblePlanError(f"{n} shipments lack a calibrated probability for some vehicle")
    return aligned


def status_quo(df: DataFrame) -> DataFrame:
    """Shipments, CO2 and freight of the assignment as it ran, by the formula."""
    return df.groupBy("Vehicle_Type").agg(
        F.count("*").alias("shipments"), F.sum(fx.co2_kg()).alias("co2_kg"), F.sum(fx.freight_cost()).alias("freight"))


def observed_caps(df: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    """(Vehicle_Type, cap) at the observed mix; a vehicle never used gets 0."""
    counts = df.agg(*[F.count_if(F.col("Vehicle_Type") == v).alias(f"n{i}") for i, v in enumerate(fleet)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("Vehicle_Type"), F.col(f"n{i}").alias("cap")) for i, v in enumerate(fleet)])).alias("x")
    ).select("x.*")


def caps_dict(caps: DataFrame) -> dict[str, int]:
    return {r["Vehicle_Type"]: int(r["cap"]) for r in caps.collect()}


def vehicle_spread(panel: DataFrame, score="p") -> DataFrame:
    """(Shipment_ID, spread): range of the probability over the vehicles."""
    return panel.groupBy("Shipment_ID").agg((F.max(score) - F.min(score)).alias("spread"))


def vehicle_spread_wide(wide: DataFrame, fleet=P.VEHICLES) -> DataFrame:
    cols = [F.col(f"p{i}") for i in range(len(fleet))]
    return wide.select("Shipment_ID", (F.greatest(*cols) - F.least(*cols)).alias("spread"))


def worst_shipment(spread: DataFrame) -> DataFrame:
    """The largest spread; the first id on a tie."""
    return spread.orderBy(F.desc("spread"), "Shipment_ID").limit(1)


def vehicle_guard(panel: DataFrame, bound=P.MAX_VEHICLE_SPREAD, score="p") -> DataFrame:
    """One row: worst spread and shipment, verdict, shipments, and mean probability per vehicle."""
    return _verdict(vehicle_spread(panel, score), panel.agg(F.map_from_entries(F.array(*[
        F.struct(F.lit(v), F.avg(F.when(F.col("Vehicle_Type") == v, F.col(score)))) for v in P.VEHICLES]))), bound)


def calibrated_guard(wide: DataFrame, bound=P.MAX_VEHICLE_SPREAD, fleet=P.VEHICLES) -> DataFrame:
    """The same on p0.. columns, where no shuffle of the panel is needed."""
    means = wide.agg(F.map_from_entries(F.array(*[F.struct(F.lit(v), F.avg(f"p{i}")) for i, v in enumerate(fleet)])))
    return _verdict(vehicle_spread_wide(wide, fleet), means, bound)


def _verdict(spread: DataFrame, means: DataFrame, bound: float) -> DataFrame:
    n = spread.agg(F.count("*")).scalar()
    return worst_shipment(spread).select(
        F.col("spread").alias("worst_spread"), F.col("Shipment_ID").alias("worst_shipment"),
        (F.col("spread") < bound).alias("passed"), n.alias("shipments"), means.scalar().alias("vehicle_means"))


def require_guard(verdict: DataFrame, bound=P.MAX_VEHICLE_SPREAD) -> DataFrame:
    row = verdict.first()
    if row is not None and not row["passed"]:
        raise VehicleEffectError(f"the vehicle moves the delay probability of {row['worst_shipment']} by "
                                 f"{row['worst_spread']:.4f}, at least {bound}")
    return verdict


def group_mean_leak(scored: DataFrame, bound=P.MAX_VEHICLE_SPREAD, score="Delay_Risk_Probability") -> DataFrame:
    """Range of the vehicles' mean scores, with the rows and vehicles behind it."""
    means = scored.groupBy("Vehicle_Type").agg(F.count("*").alias("n"), F.avg(score).alias("mean"))
    return means.agg(F.sum("n").alias("shipments"), F.count("*").alias("vehicles"),
                     (F.max("mean") - F.min("mean")).alias("leak")).withColumn("passed", F.col("leak") < bound)

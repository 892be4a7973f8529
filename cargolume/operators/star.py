"""Star schema: dimensions, fact, analytical dataset and incremental routes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.errors import IntegrityError, MissingColumnsError
from cargolume.functions.calendar import calendar_columns, date_id
from cargolume.functions.keys import route_key
from cargolume.functions.formulas import is_delayed
from cargolume.schemas import FACT_COLUMNS, ROUTE_COLUMNS


def missing_columns(df: DataFrame, required) -> list[str]:
    return [c for c in required if c not in df.columns]


def unexpected_columns(df: DataFrame, expected) -> list[str]:
    return [c for c in df.columns if c not in expected]


def require_columns(df: DataFrame, required) -> DataFrame:
    gone = missing_columns(df, required)
    if gone:
        raise MissingColumnsError(f"missing columns: {gone}")
    return df


def project_features(df: DataFrame, order) -> DataFrame:
    """Model inputs in the recorded order; raises when one is absent."""
    return require_columns(df, order).select(*order)


def dim_vendor(raw: DataFrame) -> DataFrame:
    """One row per vendor with the mean rating, half-even to two decimals."""
    return raw.groupBy("Vendor_ID").agg(F.bround(F.avg("Vendor_Rating"), 2).alias("Vendor_Rating"))


def dim_route(raw: DataFrame, digits=10) -> DataFrame:
    """Distinct route attributes with their content-addressed key."""
    return raw.select(*ROUTE_COLUMNS).distinct().select(route_key(digits=digits).alias("Route_ID"), *ROUTE_COLUMNS)


def dim_date(raw: DataFrame, day="Shipment_Date") -> DataFrame:
    """Gap-free calendar between the first and the last shipment."""
    span = raw.agg(F.min(F.to_date(day)).alias("a"), F.max(F.to_date(day)).alias("b"))
    days = span.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def fact_shipments(raw: DataFrame, digits=10) -> DataFrame:
    """Fact rows; the route key is computed from the row itself, so no route join is needed."""
    return raw.withColumn("Date_ID", date_id(F.to_date("Shipment_Date"))) \
        .withColumn("Route_ID", route_key(digits=digits)).select(*FACT_COLUMNS)


def fact_by_lookup(raw: DataFrame, route: DataFrame) -> DataFrame:
    """The same by a null-safe lookup in an existing route dimension, for keys not made by content."""
    keyed = route.select("Route_ID", *[F.col(c).alias(f"r_{c}") for c in ROUTE_COLUMNS])
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ROUTE_COLUMNS]
    return raw.join(keyed, on=same, how="left").withColumn(
        "Date_ID", date_id(F.to_date("Shipment_Date"))).select(*FACT_COLUMNS)


def new_routes(existing: DataFrame, raw: DataFrame, digits=10) -> DataFrame:
    """Routes in a new load that the dimension lacks, by their attributes; keys already there stay as they are.

    A new route whose key is already that of another stops the job: its shipments would point to the wrong one.
    """
    known = existing.select(F.col("Route_ID").alias("_old"), *[F.col(c).alias(f"_{c}") for c in ROUTE_COLUMNS])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ROUTE_COLUMNS]
    fresh = dim_route(raw, digits).join(known.drop("_old"), same, "left_anti")
    taken = F.when(F.col("_old").isNull(), F.col("Route_ID")).otherwise(
        F.raise_error(F.concat(F.lit("two routes have the key "), F.col("Route_ID"))).cast("string"))
    return fresh.join(known.select("_old"), F.col("Route_ID") == F.col("_old"), "left").select(taken.alias("Route_ID"), *ROUTE_COLUMNS)


def extend_routes(existing: DataFrame, raw: DataFrame, digits=10) -> DataFrame:
    return existing.unionByName(new_routes(existing, raw, digits))


def require_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    twice = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise IntegrityError(f"{name}.{key} is not unique: {twice[0][0]!r}")
    return df


def analytical_dataset(fact: DataFrame, vendor: DataFrame, route: DataFrame, date: DataFrame,
                       check=True) -> DataFrame:
    """Fact with vendor, route and calendar attributes, and the target.

    Unique dimension keys are what keeps the row count, so they are checked instead of counting the
    fact twice. Row order means nothing in Spark: chronology is kept by (Full_Date, spread key).
    """
    if check:
        for frame, key, name in ((vendor, "Vendor_ID", "dim_vendor"), (route, "Route_ID", "dim_route"),
                                 (date, "Date_ID", "dim_date")):
            require_unique(frame, key, name)
    calendar = date.select("Date_ID", F.to_date("Full_Date").alias("Full_Date"), "Month", "Season")
    return (fact.join(vendor, "Vendor_ID", "left").join(route, "Route_ID", "left")
            .join(calendar, "Date_ID", "left").withColumn("is_delayed", is_delayed()))


def allocation_input(fact: DataFrame, route: DataFrame, vendor: DataFrame) -> DataFrame:
    return fact.join(route, "Route_ID", "left").join(vendor, "Vendor_ID", "left")


def attach_scores(fact: DataFrame, scored: DataFrame) -> DataFrame:
    return fact.join(scored.select("Shipment_ID", "Delay_Risk_Probability", "Risk_Level"), "Shipment_ID", "left")


def regrained(raw: DataFrame) -> dict[str, DataFrame]:
    """Route split into lane, vehicle and a weather x traffic condition dimension, with a keyed fact."""
    grains = {"lane": ["Origin", "Destination"], "vehicle": ["Vehicle_Type"],
              "condition": ["Weather_Condition", "Traffic_Density"]}
    prefix = {"lane": "LN-", "vehicle": "VH-", "condition": "CN-"}

    def key(name):
        return F.regexp_replace(route_key(grains[name]), "^RT-", prefix[name]).alias(f"{name}_id")

    out = {name: raw.select(*cols).distinct().select(key(name), *cols) for name, cols in grains.items()}
    out["fact"] = raw.select("Shipment_ID", *[key(n) for n in grains])
    return out

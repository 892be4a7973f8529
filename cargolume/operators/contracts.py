"""Column contracts, integrity checks and quarantines as tables of findings."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import IntegrityError
from cargolume.schemas import SCORED_COLUMNS

ROUTE_PATTERN = r"^RT-[0-9a-f]{10}$"
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


@dataclass(frozen=True)
class Rule:
    """A row passes when `ok` is true; null counts as a violation."""

    name: str
    column: str
    ok: Column


def pattern(column, regex):
    return Rule(f"{column} matches", column, F.col(column).cast("string").rlike(regex))


def not_null(column):
    return Rule(f"{column} not null", column, F.col(column).isNotNull())


def number(column, low=None, high=None, above=None, kind="double"):
    """Coerced to a number first; text that is no number violates the rule."""
    v = F.col(column).try_cast(kind)
    ok = v.isNotNull() & ~F.isnan(v.cast("double"))
    for bound, test in ((low, lambda: v >= low), (high, lambda: v <= high), (above, lambda: v > above)):
        if bound is not None:
            ok = ok & test()
    return Rule(f"{column} in range", column, ok)


def one_of(column, values):
    return Rule(f"{column} in set", column, F.col(column).isin(list(values)))


def raw_rules(shipment_pattern=r"^SHP-\d{5}$", vendor_pattern=r"^VEND-\d{3}$", max_weight=P.MAX_WEIGHT_TONS):
    return [
        pattern("Shipment_ID", shipment_pattern), pattern("Shipment_Date", DAY_PATTERN),
        pattern("Vendor_ID", vendor_pattern), number("Vendor_Rating", 1.0, 5.0), not_null("Origin"),
        not_null("Destination"), number("Distance_km", above=0.0, high=P.MAX_DISTANCE_KM),
        number("Weight_tons", above=0.0, high=max_weight), one_of("Weather_Condition", P.WEATHER),
        one_of("Traffic_Density", P.TRAFFIC), one_of("Vehicle_Type", P.VEHICLES),
        number("Actual_Delay_Days", 0, P.MAX_DELAY_CONTRACT, kind="int"), number("CO2_Emission_kg", above=0.0),
    ]


def vendor_rules(vendor_pattern=r"^VEND-\d{3}$"):
    return [pattern("Vendor_ID", vendor_pattern), number("Vendor_Rating", 1.0, 5.0)]


def route_rules(route_pattern=ROUTE_PATTERN):
    return [pattern("Route_ID", route_pattern), not_null("Origin"), not_null("Destination"),
            one_of("Vehicle_Type", P.VEHICLES), one_of("Weather_Condition", P.WEATHER),
            one_of("Traffic_Density", P.TRAFFIC)]


def fact_rules(shipment_pattern=r"^SHP-\d{5}$", vendor_pattern=r"^VEND-\d{3}$", route_pattern=ROUTE_PATTERN,
               max_weight=P.MAX_WEIGHT_TONS):
    return [
        pattern("Shipment_ID", shipment_pattern), number("Date_ID", 19000101, 99991231, kind="int"),
        pattern("Vendor_ID", vendor_pattern), pattern("Route_ID", route_pattern),
        number("Weight_tons", above=0.0, high=max_weight), number("Distance_km", above=0.0, high=P.MAX_DISTANCE_KM),
        number("Actual_Delay_Days", 0, P.MAX_DELAY_CONTRACT, kind="int"), number("CO2_Emission_kg", above=0.0),
    ]


def scored_rules(**kw):
    return fact_rules(**kw) + [number("Delay_Risk_Probability", 0.0, 1.0), one_of("Risk_Level", P.TIERS)]


def contract_report(df: DataFrame, table: str, rules: list[Rule], unique: str | None = None) -> DataFrame:
    """(table, rule, violations, example) for every rule; one aggregate pass, plus one for the key."""
    absent = [r for r in rules if r.column not in df.columns]
    here = [r for r in rules if r.column in df.columns]
    measures = []
    for i, rule in enumerate(here):
        broken = ~F.coalesce(rule.ok, F.lit(False))
        measures += [F.count_if(broken).alias(f"n{i}"),
                     F.min(F.when(broken, F.col(rule.column).cast("string"))).alias(f"e{i}")]
    found = [F.struct(F.lit(r.name).alias("rule"), F.col(f"n{i}").alias("violations"),
                      F.col(f"e{i}").alias("example")) for i, r in enumerate(here)]
    found += [F.struct(F.lit(f"{r.column} present").alias("rule"), F.lit(1).cast("long").alias("violations"),
                       F.lit(None).cast("string").alias("example")) for r in absent]
    out = df.agg(F.count("*").alias("rows"), *measures).select(F.explode(F.array(*found)).alias("x")).select(
        F.lit(table).alias("table"), "x.*")
    if unique:
        twice = df.groupBy(F.col(unique).cast("string").alias("k")).agg(F.count("*").alias("n")).where("n > 1")
        out = out.unionByName(twice.agg(F.count("*").alias("violations"), F.min("k").alias("example")).select(
            F.lit(table).alias("table"), F.lit(f"{unique} unique").alias("rule"), "violations", "example"))
    return out


def require_clean(report: DataFrame) -> DataFrame:
    bad = report.where("violations > 0").orderBy("rule").limit(20).collect()
    if bad:
        raise IntegrityError("; ".join(f"{b['table']}: {b['rule']} ({b['violations']}, e.g. {b['example']})" for b in bad))
    return report


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys of the child that the parent lacks, with their rows.

    The child is reduced to its distinct keys before the join, so a hot key costs one row.
    """
    return child.groupBy(key).agg(F.count("*").alias("shipments")).join(
        parent.select(F.col(key).alias("_p")), F.col(key) == F.col("_p"), "left_anti")


def star_integrity(fact: DataFrame, vendor: DataFrame, route: DataFrame, date: DataFrame) -> DataFrame:
    """(check, violations) for keys, calendar, nulls and foreign keys."""
    def duplicates(df, key, name):
        n = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("violations"))
        return n.select(F.lit(f"{name}.{key} unique").alias("check"), "violations")

    day = F.to_date("Full_Date")
    gaps = date.agg((F.datediff(F.max(day), F.min(day)) + 1 - F.count("*")).cast("long").alias("violations")).select(
        F.lit("dim_date contiguous").alias("check"), F.abs("violations").alias("violations"))
    nulls = fact.agg(F.count_if(F.col("Route_ID").isNull()).alias("r"), F.count_if(F.col("Date_ID").isNull()).alias("d"))
    nulls = nulls.select(F.explode(F.array(
        F.struct(F.lit("fact.Route_ID not null").alias("check"), F.col("r").alias("violations")),
        F.struct(F.lit("fact.Date_ID not null").alias("check"), F.col("d").alias("violations")))).alias("x")).select("x.*")
    out = duplicates(vendor, "Vendor_ID", "dim_vendor")
    for df, key, name in ((route, "Route_ID", "dim_route"), (date, "Date_ID", "dim_date"),
                          (fact, "Shipment_ID", "fact")):
        out = out.unionByName(duplicates(df, key, name))
    out = out.unionByName(gaps).unionByName(nulls)
    for parent, key in ((vendor, "Vendor_ID"), (route, "Route_ID"), (date, "Date_ID")):
        lost = orphan_keys(fact.where(F.col(key).isNotNull()), parent, key).agg(
            F.coalesce(F.sum("shipments"), F.lit(0)).alias("violations"))
        out = out.unionByName(lost.select(F.lit(f"fact.{key} resolves").alias("check"), "violations"))
    return out


def require_integrity(findings: DataFrame) -> None:
    bad = findings.where("violations > 0").orderBy("check").collect()
    if bad:
        raise IntegrityError("; ".join(f"{b['check']}: {b['violations']}" for b in bad))


def output_integrity(scored: DataFrame, fact: DataFrame, vendor: DataFrame, route: DataFrame,
                     date: DataFrame) -> DataFrame:
    """(check, violations) for the scored table: rows, key, score, column order and foreign keys."""
    a = scored.agg(F.count("*").alias("a"), F.count_if(F.col("Delay_Risk_Probability").isNull()).alias("nulls"))
    expected = fact.agg(F.count("*")).scalar()
    order = int(scored.columns != SCORED_COLUMNS)
    first = a.withColumn("b", expected).select(F.explode(F.array(
        F.struct(F.lit("row count").alias("check"), F.abs(F.col("a") - F.col("b")).alias("violations")),
        F.struct(F.lit("score not null").alias("check"), F.col("nulls").alias("violations")),
        F.struct(F.lit("column order").alias("check"), F.lit(order).cast("long").alias("violations")))).alias("x")
    ).select("x.*")
    rest = star_integrity(scored, vendor, route, date).where(
        F.col("check").isin("fact.Shipment_ID unique", "fact.Vendor_ID resolves", "fact.Route_ID resolves",
                            "fact.Date_ID resolves"))
    return first.unionByName(rest)


def physical_split(df: DataFrame, max_weight=P.MAX_ROW_WEIGHT_TONS, probability=None) -> DataFrame:
    """Adds `reasons`: why a row is impossible; empty for a valid row."""
    tests = [("Distance_km", (F.col("Distance_km") > 0) & (F.col("Distance_km") <= P.MAX_DISTANCE_KM)),
             ("Weight_tons", (F.col("Weight_tons") > 0) & (F.col("Weight_tons") <= max_weight)),
             ("Vendor_Rating", F.col("Vendor_Rating").between(1.0, 5.0))]
    if probability:
        tests.append((probability, F.col(probability).between(0.0, 1.0)))
    marks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in tests]
    return df.withColumn("reasons", F.filter(F.array(*marks), lambda m: m.isNotNull()))


def valid_rows(split: DataFrame) -> DataFrame:
    return split.where(F.size("reasons") == 0).drop("reasons")


def quarantine(split: DataFrame) -> DataFrame:
    return split.where(F.size("reasons") > 0)


def distance_consistency(df: DataFrame) -> DataFrame:
    """Spread of the distance within a city pair, worst pair first; pairs seen once are left out."""
    d = F.col("Distance_km")
    stats = df.groupBy("Origin", "Destination").agg(
        F.count("*").alias("n"), F.min(d).alias("min_km"), F.max(d).alias("max_km"), F.avg(d).alias("mean_km"),
        F.stddev_samp(d).alias("std_km"))
    return stats.where("n > 1").withColumn("cv", F.try_divide("std_km", "mean_km")).orderBy(
        F.desc("cv"), "Origin", "Destination")


def distance_violations(df: DataFrame, max_cv=P.MAX_DISTANCE_CV) -> DataFrame:
    return distance_consistency(df).where(F.col("cv") > max_cv)


def require_distance_rule(df: DataFrame, max_cv=P.MAX_DISTANCE_CV) -> DataFrame:
    bad = distance_violations(df, max_cv)
    worst = bad.limit(1).collect()
    if worst:
        w = worst[0]
        raise IntegrityError(
            f"distance is no function of the city pair: {bad.count()} pairs exceed cv={max_cv}; worst is "
            f"{w['Origin']} -> {w['Destination']}, {w['n']} shipments from {w['min_km']:.1f} to "
            f"{w['max_km']:.1f} km (cv={w['cv']:.2f})")
    return bad


def co2_drift(df: DataFrame, formula: Column, group="Vehicle_Type") -> DataFrame:
    """Stored CO2 against the formula: mean, least and largest ratio, and rows under the floor."""
    ratio = F.try_divide(F.col("CO2_Emission_kg"), formula)
    return df.groupBy(group).agg(
        F.count("*").alias("shipments"), F.avg(ratio).alias("mean_ratio"), F.min(ratio).alias("min_ratio"),
        F.max(ratio).alias("max_ratio"),
        F.count_if(F.col("CO2_Emission_kg") < P.CO2_FLOOR_KG).alias("under_floor"))


def tier_mismatches(scored: DataFrame, high=P.HIGH_THRESHOLD, medium=P.MEDIUM_THRESHOLD) -> DataFrame:
    from cargolume.functions.formulas import risk_tier

    right = risk_tier("Delay_Risk_Probability", high, medium)
    return scored.groupBy("Risk_Level").agg(
        F.count("*").alias("shipments"), F.count_if(~F.col("Risk_Level").eqNullSafe(right)).alias("mismatches"))

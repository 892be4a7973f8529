"""Chronological and stratified splits."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume.errors import IntegrityError
from cargolume.operators.ordering import chronological_cuts, from_cut, positions
from cargolume.session import materialise


def chronological_position(df: DataFrame, day="Full_Date", key="Shipment_ID", **kw) -> DataFrame:
    return positions(df, day, key, **kw)


def chronological_holdout(df: DataFrame, fraction=0.8, day="Full_Date", key="Shipment_ID") -> DataFrame:
    """Adds `split`: the first int(fraction * n) rows are train, the rest test."""
    n = df.count()
    cut = chronological_cuts(df, [int(n * fraction)], day, key)[0]
    return df.withColumn("split", F.when(from_cut(cut, day, key), "test").otherwise("train"))


def require_chronology(split: DataFrame, day="Full_Date") -> DataFrame:
    """Train must end no later than test begins; the same day may be on both sides."""
    ends = split.agg(F.max(F.when(F.col("split") == "train", F.col(day))).alias("a"),
                     F.min(F.when(F.col("split") == "test", F.col(day))).alias("b")).first()
    if ends["a"] is not None and ends["b"] is not None and ends["a"] > ends["b"]:
        raise IntegrityError(f"train reaches {ends['a']}, after the first test day {ends['b']}")
    return split


def expanding_folds(df: DataFrame, k=5, day="Full_Date", key="Shipment_ID") -> DataFrame:
    """Adds `fold`: 1..k in time order, each of n // (k+1) rows; 0 is the warm-up before them.

    Fold f is tested by a model of all rows with a smaller fold.
    """
    n = df.count()
    size = n // (k + 1)
    cuts = chronological_cuts(df, [n - (k - i) * size for i in range(k)], day, key)
    fold = F.lit(0)
    for c in cuts:
        fold = fold + from_cut(c, day, key).cast("int")
    return df.withColumn("fold", fold)


def stratified_folds(df: DataFrame, k=5, label="is_delayed", key="Shipment_ID", **kw) -> DataFrame:
    """Adds `fold` 0..k-1; every class is dealt out evenly in hash order."""
    dealt = positions(df, label, key, out="_deal", overall=False, **kw)
    return dealt.withColumn("fold", F.pmod("_deal", F.lit(k)).cast("int")).drop("_deal")


def grouped_folds(df: DataFrame, k=5, group="Vendor_ID", label="is_delayed", rows=None, **kw) -> DataFrame:
    """Adds `fold` 0..k-1; a group never spans folds, and sizes and late shares stay balanced.

    Groups are first reduced to (rows, late rows). Those of alike size and late share are dealt out
    back and forth in hash order, so there is no walk over the groups on the driver. `rows`: `df` with further columns, the
    one that gets the folds.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"), F.sum(label).alias("_pos"))
    size_class = F.floor(F.log2(F.col("_n").cast("double")) * 4)
    share_class = F.floor(F.col("_pos") / F.col("_n") * 20)
    stratum = (size_class * 32 + share_class).cast("long")
    dealt = positions(sizes.withColumn("_stratum", stratum), "_stratum", group, out="_deal", **kw)
    turn = F.pmod("_deal", F.lit(2 * k))
    fold = F.when(turn < k, turn).otherwise(2 * k - 1 - turn).cast("int")
    dealt = materialise(dealt.select(group, fold.alias("fold")), "group-folds")  # its size is known, so the rows need not move
    return (df if rows is None else rows).join(dealt, group, "left")


def fold_summary(df: DataFrame, day="Full_Date", label="is_delayed") -> DataFrame:
    return df.groupBy("fold").agg(
        F.count("*").alias("shipments"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.avg(label).alias("delay_rate"))


def weekly_budget(planned: DataFrame, monthly_capacity: dict[str, float], day="Full_Date") -> DataFrame:
    """Use per week with the month's capacity carried as a running budget, per vehicle.

    Grouped to (vehicle, month, week) before the window, so a window holds at most six rows.
    """
    from cargolume.functions.formulas import lookup

    weekly = planned.groupBy(
        "Vehicle_Type", F.date_format(day, "yyyy-MM").alias("month"),
        F.to_date(F.date_trunc("week", F.col(day))).alias("week")).agg(F.count("*").alias("used"))
    running = Window.partitionBy("Vehicle_Type", "month").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("used").over(running)
    capacity = lookup("Vehicle_Type", monthly_capacity)
    return weekly.select("Vehicle_Type", "month", "week", "used", total.alias("used_to_date"),
                         (capacity - (total - F.col("used"))).alias("budget_before"),
                         (capacity - total).alias("budget_after"))


def running_use(per: DataFrame, monthly_capacity: dict[str, int]) -> DataFrame:
    """Of rows (month, week, Vehicle_Type, n, ids): per week its shipments and ids, and whether a vehicle's use since the month began is above capacity."""
    from cargolume.functions.formulas import lookup

    running = Window.partitionBy("Vehicle_Type", "month").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    over = F.sum("n").over(running) > lookup("Vehicle_Type", monthly_capacity)
    return per.withColumn("over", over).groupBy("month", "week").agg(
        F.sum("n").alias("shipments"), F.sum("ids").alias("planned"), F.bool_or("over").alias("over_budget"))

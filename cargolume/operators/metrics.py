"""Ranking, calibration, alert-cost and class metrics on (score, label)."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.session import literal_rows, materialise

RANGE_ROWS = 500_000


def _bin(p: Column, bins: int, right_closed=False) -> Column:
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    out = F.lit(0)
    for e in edges:
        out = out + ((p > e) if right_closed else (p >= e)).cast("int")
    return F.when(p.between(0.0, 1.0), out)


def present(column: str) -> Column:
    """The column as a number; a row without one, or with NaN, stops the job."""
    x = F.col(column).cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x), x).otherwise(F.raise_error(F.lit(f"{column} is missing or not a number")).cast("double"))


def score_counts(df: DataFrame, score: str, label="is_delayed", by=(), weight=None) -> DataFrame:
    """Late and on-time rows per exact score; every metric below starts from these.

    A row without a score or a label has no place in a ranking, so the job fails on it. `weight`: a column with the number
    of like rows that a row stands for.
    """
    n = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return df.groupBy(*by, present(score).alias("p")).agg(
        F.sum(present(label) * n).alias("pos"), F.sum((1.0 - present(label)) * n).alias("neg"))


def auc_of_counts(counts: DataFrame, by=(), range_rows=RANGE_ROWS) -> DataFrame:
    """ROC-AUC with ties as one half, from score counts.

    Scores are cut into ranges of about equal depth: totals per range give the late rows above it, and
    each range is ranked on its own. Counts are whole numbers, so the cuts do not change the result.
    `counts` must be a stored table, since it is read more than once.
    """
    by = list(by)
    ranges = -(-counts.count() // range_rows) * 2
    marks = counts.approxQuantile("p", [i / ranges for i in range(1, ranges)], 0.1 / max(ranges, 1)) if ranges else []
    edges = [float("-inf"), *sorted(set(marks) - {float("inf"), float("-inf")}), float("inf")]
    cut = Bucketizer(splits=edges, inputCol="p", outputCol="_range").transform(counts) \
        if len(edges) > 2 else counts.withColumn("_range", F.lit(0.0))
    totals = cut.groupBy(*by, "_range").agg(F.sum("pos").alias("_pos"))
    higher = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_pos").over(higher), F.lit(0.0)).alias("_above"))
    inside = Window.partitionBy(*by, "_range").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range") == F.col("_r")
    for c in by:  # a null group is a group
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    ranked = cut.withColumn("_in", F.coalesce(F.sum("pos").over(inside), F.lit(0.0))).join(totals, same)
    above = F.col("_above") + F.col("_in")
    return ranked.groupBy(*by).agg(F.try_divide(
        F.sum(F.col("neg") * (above + F.col("pos") / 2.0)), F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def roc_auc(df: DataFrame, score: str, label="is_delayed", by=(), range_rows=RANGE_ROWS, weight=None) -> DataFrame:
    counts = materialise(score_counts(df, score, label, by, weight), "scores")
    return auc_of_counts(counts, by, range_rows)


def _brier_ece(counts: DataFrame, by=(), bins=10) -> DataFrame:
    p, pos, neg = F.col("p"), F.col("pos"), F.col("neg")
    n = pos + neg
    binned = counts.groupBy(*by, _bin(p, bins).alias("_bin")).agg(
        F.sum(n).alias("n"), F.sum(pos).alias("pos"), F.sum(p * n).alias("ps"),
        F.sum(pos * (1.0 - p) * (1.0 - p) + neg * p * p).alias("sq"))
    gap = F.when(F.col("_bin").isNotNull(), F.abs(F.col("ps") - F.col("pos"))).otherwise(F.lit(0.0))
    total, late = F.sum("n"), F.sum("pos")
    return binned.groupBy(*by).agg(
        total.cast("long").alias("shipments"), (F.sum("sq") / total).alias("brier"), (F.sum(gap) / total).alias("ece"),
        (late / total * (1.0 - late / total)).alias("baseline_brier"))


def calibration_error(df: DataFrame, score: str, label="is_delayed", bins=10, by=(), weight=None) -> DataFrame:
    """Brier score, expected calibration error and the Brier score of the constant base rate."""
    return _brier_ece(score_counts(df, score, label, by, weight), by, bins)


def metric_bundle(df: DataFrame, score: str, label="is_delayed", by=(), bins=10, weight=None) -> DataFrame:
    """ROC-AUC, Brier, ECE and baseline Brier from one scan of the data."""
    by = list(by)
    counts = materialise(score_counts(df, score, label, by, weight), "scores")
    auc, rest = auc_of_counts(counts, by), _brier_ece(counts, by, bins)
    return auc.join(rest, by) if by else rest.withColumn("roc_auc", auc.scalar())


def reliability_curve(df: DataFrame, score: str, label="is_delayed", bins=10) -> DataFrame:
    """Mean probability and realised rate per right-closed bin; empty bins are left out."""
    return df.groupBy(_bin(F.col(score), bins, right_closed=True).alias("bin")).agg(
        F.count("*").alias("shipments"), F.avg(score).alias("mean_predicted"), F.avg(label).alias("realised_rate"))


def calibration_by_tier(scored: DataFrame) -> DataFrame:
    """One row per tier in fixed order; a tier without shipments keeps nulls."""
    found = scored.groupBy("Risk_Level").agg(
        F.count("Shipment_ID").alias("shipments"), F.avg("Delay_Risk_Probability").alias("mean_predicted"),
        F.avg("is_delayed").alias("realised_rate"), F.avg("Actual_Delay_Days").alias("mean_delay_days"))
    tiers = literal_rows(scored.sparkSession, ["tier_order", "Risk_Level"], list(enumerate(P.TIERS)))
    return tiers.join(found, "Risk_Level", "left").withColumn(
        "deviation", F.col("mean_predicted") - F.col("realised_rate")).orderBy("tier_order")


def alert_cost(df: DataFrame, score: str, threshold: float, ratio=P.COST_RATIO, label="is_delayed") -> DataFrame:
    return alert_cost_curve(df, score, [threshold], [ratio], label)


def alert_cost_curve(df: DataFrame, score: str, thresholds, ratios, label="is_delayed") -> DataFrame:
    """tp, fp, fn, alert rate and cost for every threshold and cost ratio.

    Rows are first reduced to the threshold interval of their score, so the grid is laid over at most
    len(thresholds) + 1 rows.
    """
    thresholds = sorted(thresholds)
    passed = F.lit(0)
    for t in thresholds:
        passed = passed + (F.col(score) >= t).cast("int")
    y = F.col(label).cast("long")
    cells = df.groupBy(passed.alias("passed")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(float(t)).alias("threshold"))
                               for i, t in enumerate(thresholds)]))
    alert = F.col("passed") >= F.col("g.i")
    curve = cells.withColumn("g", grid).groupBy("g.threshold").agg(
        F.sum(F.when(alert, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(alert, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~alert, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.col("pos") + F.col("neg")).alias("n"))
    out = curve.withColumn("cost_ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
    return out.select("threshold", "cost_ratio", "tp", "fp", "fn",
                      ((F.col("tp") + F.col("fp")) / F.col("n")).alias("alert_rate"),
                      (F.col("fp") + F.col("cost_ratio") * F.col("fn")).alias("cost"))


def classification_report(df: DataFrame, score: str, label="is_delayed", threshold=0.5, by=()) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    hit, late = F.col(score) >= threshold, F.col(label) == 1
    c = df.groupBy(*by).agg(
        F.count_if(hit & late).alias("tp"), F.count_if(hit & ~late).alias("fp"),
        F.count_if(~hit & late).alias("fn"), F.count_if(~hit & ~late).alias("tn"))

    def part(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def f1(p, r):
        return part(2.0 * p * r, p + r)

    p1, r1, p0, r0 = part(tp, tp + fp), part(tp, tp + fn), part(tn, tn + fn), part(tn, tn + fp)
    s1, s0 = tp + fn, tn + fp

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support"))

    acc = part(tp + tn, n)

    def macro(a, b):
        return (a + b) / 2.0

    def weighted(a, b):
        return part(a * s0 + b * s1, n)

    rows = [row("0", p0, r0, f1(p0, r0), s0), row("1", p1, r1, f1(p1, r1), s1), row("accuracy", acc, acc, acc, n),
            row("macro avg", macro(p0, p1), macro(r0, r1), macro(f1(p0, r0), f1(p1, r1)), n),
            row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f1(p0, r0), f1(p1, r1)), n)]
    return c.select(*by, F.explode(F.array(*rows)).alias("x")).select(*by, "x.*")


def distribution_shift(split: DataFrame, column="Weather_Condition") -> DataFrame:
    """Share per category in train and test, 0 where absent, and the difference; one pass."""
    cells = split.groupBy(column).agg(F.count_if(F.col("split") == "train").alias("a"),
                                      F.count_if(F.col("split") == "test").alias("b"))
    all_a, all_b = cells.agg(F.sum("a")).scalar(), cells.agg(F.sum("b")).scalar()
    train = F.coalesce(F.try_divide(F.col("a"), all_a), F.lit(0.0))
    test = F.coalesce(F.try_divide(F.col("b"), all_b), F.lit(0.0))
    return cells.select(column, train.alias("train_share"), test.alias("test_share"), (test - train).alias("difference"))


def category_shares(df: DataFrame, column: str) -> DataFrame:
    cells = df.groupBy(column).agg(F.count("*").alias("shipments"))
    total = cells.agg(F.sum("shipments")).scalar()
    return cells.select(column, "shipments", (F.col("shipments") / total).alias("share"))


def majority_baseline(df: DataFrame, label="is_delayed") -> DataFrame:
    return category_shares(df, label).agg(F.max("share").alias("majority_share"))


def training_profile(df: DataFrame, numeric, categorical, label="is_delayed", day="Full_Date") -> DataFrame:
    """One row: sorted levels, min and max per numeric feature, rows, late share and date range."""
    levels = F.create_map(*[x for c in categorical for x in (F.lit(c), F.array_sort(F.collect_set(c)))])
    ranges = F.create_map(*[x for c in numeric for x in (
        F.lit(c), F.struct(F.min(F.col(c)).alias("min"), F.max(F.col(c)).alias("max")))])
    return df.agg(levels.alias("categorical_levels"), ranges.alias("numeric_ranges"), F.count("*").alias("n_rows"),
                  F.bround(F.avg(label), 4).alias("positive_rate"), F.min(day).alias("date_min"),
                  F.max(day).alias("date_max"))


def numeric_ranges(profile: DataFrame) -> dict:
    """{feature: (min, max)} of a training profile, as the extrapolation check takes it."""
    row = profile.select("numeric_ranges").first()[0]
    return {k: (v["min"], v["max"]) for k, v in row.items()}

"""Exact order statistics and positions without a one-task sort of the data.

Positions inside a day or class follow the hash of the id. A hash prefix cuts a hot group into equal
slices that keep this order, so a day that holds a third of all rows is spread over many tasks.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume.functions.keys import spread_key

SLICE_ROWS = 100_000
PICK_ROWS = 50_000
BINS = 2048
GROUP_ROWS = 32_768


def positions(df: DataFrame, group: str, key="Shipment_ID", out="position", overall=True,
              slice_rows=SLICE_ROWS) -> DataFrame:
    """0-based row position by (group, hash of key); per group when `overall` is false.

    `group` must be bounded (a day, a class): its counts fit one task, and are sent to the rows; rows dealt by group
    would put a class into one task. Slices are small, so that those which meet in a task stay small. Null groups come first.
    """
    tagged = df.withColumn("_tie", spread_key(key))
    sizes = tagged.groupBy(group).agg(F.count("*").alias("_rows"))
    # Hex digits of the hash that bring a slice of this group under slice_rows.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("_rows") / F.lit(float(slice_rows)))))
    ordered = Window.orderBy(group)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)) if overall else F.lit(0).cast("long")
    sizes = sizes.select(F.col(group).alias("_g"), F.row_number().over(ordered).alias("_gid"),
                         digits.cast("int").alias("_digits"), start.alias("_start"))
    sliced = tagged.join(F.broadcast(sizes), F.col(group).eqNullSafe(F.col("_g")), "left").withColumn(
        "_slice", F.expr("substring(_tie, 1, _digits)"))
    inner = Window.partitionBy("_gid").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_gid", "_slice").agg(F.count("*").alias("_n")).select(
        "_gid", "_slice", F.coalesce(F.sum("_n").over(inner), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_gid", "_slice").orderBy("_tie")
    # The hash is longer than many a row: it is made again behind the shuffle.
    numbered = sliced.drop("_tie").repartition("_gid", "_slice").withColumn("_tie", spread_key(key)).withColumn("_in", F.row_number().over(within) - 1)
    joined = numbered.join(offsets, ["_gid", "_slice"], "left")
    return joined.withColumn(out, (F.col("_start") + F.col("_offset") + F.col("_in")).cast("long")).select(
        *df.columns, out)


def _kth_hash(df: DataFrame, k: int, rows: int, prefix="", pick_rows=PICK_ROWS) -> str:
    """The k-th smallest (0-based) hash among rows whose hash starts with prefix."""
    while rows > pick_rows:
        n = len(prefix) + 3
        bins = (df.where(F.col("_tie").startswith(prefix)) if prefix else df).groupBy(
            F.substring("_tie", 1, n).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
        for b in bins:  # at most 4096 rows
            if k < b["n"]:
                prefix, rows = b["p"], b["n"]
                break
            k -= b["n"]
        else:
            raise ValueError("position lies beyond the group")
        if len(prefix) >= 40:
            return prefix
    near = (df.where(F.col("_tie").startswith(prefix)) if prefix else df).select("_tie").orderBy("_tie").limit(k + 1)
    return near.agg(F.max("_tie").alias("t")).first()["t"]


def chronological_cuts(df: DataFrame, at: list[int], day="Full_Date", key="Shipment_ID",
                       pick_rows=PICK_ROWS) -> list[tuple | None]:
    """For each position the (day, hash) of the row there; None past the end.

    One count per day, then a look into the boundary days alone. Rows are never sorted or shuffled.
    """
    running = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    days = df.groupBy(F.col(day).alias("d")).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(running))
    wanted = F.lit(False)
    for p in at:
        wanted = wanted | ((F.col("upto") > p) & (F.col("upto") - F.col("n") <= p))
    hit = days.where(wanted).collect()
    cuts = []
    for p in at:
        row = next((h for h in hit if h["upto"] - h["n"] <= p < h["upto"]), None)
        if row is None:
            cuts.append(None)
            continue
        inside = df.where(F.col(day).eqNullSafe(F.lit(row["d"]))).select(spread_key(key).alias("_tie"))
        cuts.append((row["d"], _kth_hash(inside, p - (row["upto"] - row["n"]), row["n"], pick_rows=pick_rows)))
    return cuts


def from_cut(cut, day="Full_Date", key="Shipment_ID"):
    """True for rows at or after the cut."""
    if cut is None:
        return F.lit(False)
    d, tie = cut
    return (F.col(day) > F.lit(d)) | ((F.col(day) == F.lit(d)) & (spread_key(key) >= F.lit(tie)))


def kth_values(df: DataFrame, column: str, ranks: list[int], pick_rows=PICK_ROWS, bins=BINS) -> list[tuple]:
    """Exact order statistics of a double column: (value, rows below it) per 0-based rank.

    Nulls are left out; NaN or an infinite value has no place on a scale and raises. Histograms narrow the value range; every pass is a map-side aggregate of at most `bins` rows, all
    ranks share a pass, and only the last `pick_rows` rows of a range are looked at one by one.
    """
    x = F.col(column).cast("double")
    rows = df.where(x.isNotNull()).select(x.alias("x"))
    odd = F.isnan("x") | (F.abs(F.col("x")) == float("inf"))
    top = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n"), F.count_if(odd).alias("odd")).first()
    if top["odd"]:
        raise ValueError(f"{top['odd']} values of {column} are NaN or infinite")
    state = {k: (top["lo"], top["hi"], 0, top["n"]) for k in ranks}  # low, high, rows below, rows inside
    for k in ranks:
        if not 0 <= k < top["n"]:
            raise ValueError(f"rank {k} lies outside {top['n']} rows")
    while True:
        wide = sorted({(s[0], s[1], s[2], s[3]) for s in state.values() if s[0] < s[1] and s[3] > pick_rows})
        if not wide:
            break
        for lo, hi, below, _ in wide:
            step = (hi - lo) / bins
            slot = F.least(F.floor((F.col("x") - lo) / step), F.lit(bins - 1)) if step > 0 else F.col("x") - lo
            hist = rows.where(F.col("x").between(lo, hi)).groupBy(slot.alias("b")).agg(
                F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("z")).orderBy("b").collect()
            for k, s in list(state.items()):
                if s[:3] == (lo, hi, below):
                    seen = below
                    for h in hist:
                        if k < seen + h["n"]:
                            state[k] = (h["a"], h["z"], seen, h["n"])
                            break
                        seen += h["n"]
    for lo, hi, below, n in {s for s in state.values() if s[0] < s[1]}:
        near = rows.where(F.col("x").between(lo, hi)).groupBy("x").agg(F.count("*").alias("n")).orderBy("x").collect()
        for k, s in list(state.items()):
            if s == (lo, hi, below, n):
                seen = below
                for v in near:
                    if k < seen + v["n"]:
                        state[k] = (v["x"], v["x"], seen, v["n"])
                        break
                    seen += v["n"]
    return [(state[k][0], state[k][2]) for k in ranks]


def kth_by_group(rows: DataFrame, ranks: dict[int, int], pick_rows=None, bins=None) -> dict[int, tuple]:
    """`kth_values` for several groups of (group, x) at once: group -> (value, rows below it) at its 0-based rank.

    All groups share every pass, which sends about `GROUP_ROWS` rows to the driver, few groups as many as many: the fewer
    groups, the fewer passes.
    """
    pick_rows = pick_rows or max(5_000, GROUP_ROWS // max(len(ranks), 1))
    bins = bins or max(BINS, GROUP_ROWS // max(len(ranks), 1))
    def inside(state):
        lo, hi = ({g: float(s[i]) for g, s in state.items()} for i in (0, 1))
        return rows.where(F.col("group").isin(list(state)) & F.col("x").between(_of_group(lo), _of_group(hi)))

    found = {r["group"]: r for r in rows.groupBy("group").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")).collect()}
    for g, k in ranks.items():
        if g not in found or not 0 <= k < found[g]["n"]:
            raise ValueError(f"rank {k} lies outside the {found[g]['n'] if g in found else 0} rows of group {g}")
    state = {g: (found[g]["lo"], found[g]["hi"], 0, found[g]["n"]) for g in ranks}  # low, high, rows below, rows inside
    while open_ := {g: s for g, s in state.items() if s[0] < s[1]}:
        near = {g: s for g, s in open_.items() if s[3] <= pick_rows}
        wide = {g: s for g, s in open_.items() if g not in near}
        if near:
            hist = inside(near).groupBy("group", F.col("x").alias("b")).agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("z"))
        else:
            step = {g: (s[1] - s[0]) / bins for g, s in wide.items()}
            slot = F.least(F.floor((F.col("x") - _of_group({g: float(s[0]) for g, s in wide.items()})) / _of_group(step)), F.lit(bins - 1))
            hist = inside(wide).groupBy("group", slot.alias("b")).agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("z"))
        by = {}
        for h in hist.collect():
            by.setdefault(h["group"], []).append(h)
        for g, hs in by.items():
            seen = state[g][2]
            for h in sorted(hs, key=lambda h: h["a"]):
                if ranks[g] < seen + h["n"]:
                    state[g] = (h["a"], h["z"], seen, h["n"])
                    break
                seen += h["n"]
    return {g: (s[0], s[2]) for g, s in state.items()}


def _of_group(values: dict):
    """The row's entry of a dict by group number, as an array that is looked into by number."""
    return F.get(F.array(*[F.lit(float(values[g])) if g in values else F.lit(None).cast("double") for g in range(max(values) + 1)]), F.col("group"))


def quantiles(df: DataFrame, column: str, fractions: list[float]) -> list[float]:
    """Exact linearly interpolated quantiles."""
    n = df.where(F.col(column).isNotNull()).count()
    if n == 0:
        return []
    spots = [f * (n - 1) for f in fractions]
    ranks = sorted({math.floor(s) for s in spots} | {math.ceil(s) for s in spots})
    value = dict(zip(ranks, [v for v, _ in kth_values(df, column, ranks)]))
    return [value[math.floor(s)] + (value[math.ceil(s)] - value[math.floor(s)]) * (s - math.floor(s)) for s in spots]


def quartile(column: str, cuts: list[float]):
    """1..4 by right-closed quartile ranges."""
    c = F.col(column)
    return F.when(c <= cuts[0], 1).when(c <= cuts[1], 2).when(c <= cuts[2], 3).when(c.isNotNull(), 4)

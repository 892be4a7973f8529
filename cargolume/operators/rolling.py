"""A rolling plan: vehicles are allocated week by week, with each month's capacity carried as a running budget.

A week does not know the demand that follows. It may use its share of what is left of the month's capacity, by days, and
more only where its own shipments need it. What passes from week to week is the remaining capacity and the last prices;
both are stored, so that a run goes on where a lost one stopped.

The walk over the weeks needs no shipments, only cells of like ones: a bounded table per week. It fixes how many shipments
of a week take each vehicle. The plan is then made for all weeks at once: every shipment draws a vehicle at its week's
prices, and each week is repaired to its numbers exactly, all weeks in the same passes.
"""

from calendar import monthrange
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError
from cargolume.functions.keys import uniform
from cargolume.operators.allocation import _Ask, _climb, _fold_cells, _together
from cargolume.operators.ordering import kth_by_group
from cargolume.session import materialise

BINS = 12
SAVE_EVERY = 12  # months between two writes of the state
TIGHTNESS = 1e-3
STATE = "month string, week date, planned array<int>, before array<int>, after array<int>, prices array<double>, tau double"


@dataclass(frozen=True)
class RollingPlan:
    """(Shipment_ID, month, week, Vehicle_Type), and the state after every week: planned, capacity before and after."""

    assignment: DataFrame
    weeks: DataFrame
    planned_now: int  # weeks that this run planned; the others were in the stored state


def periods(df: DataFrame, day="Full_Date") -> DataFrame:
    """Adds `month` (yyyy-MM) and `week` (its Monday); a week that spans two months is two periods."""
    return df.withColumn("month", F.date_format(day, "yyyy-MM")).withColumn("week", F.to_date(F.date_trunc("week", F.col(day))))


def _days(month: str, week: date) -> tuple[int, int]:
    """Days of the period, and from its first day to the end of the month."""
    year, m = map(int, month.split("-"))
    last = date(year, m, monthrange(year, m)[1])
    first = max(week, date(year, m, 1))
    return (min(week + timedelta(days=6), last) - first).days + 1, (last - first).days + 1


def _cells_by_period(panel: DataFrame, k: int) -> dict[int, tuple]:
    """group -> (rows, mean costs, zeros) of its cells: at most BINS^(k - 1) a week."""
    gaps = {f"g{i}": F.col(f"c{i}") - F.col("c0") for i in range(1, k)}
    span = panel.agg(*[f(x).alias(f"{n}_{g}") for g, x in gaps.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    slots = []
    for g, x in gaps.items():
        step = ((span[f"hi_{g}"] or 0.0) - (span[f"lo_{g}"] or 0.0)) / BINS
        slots.append((F.least(F.floor((x - span[f"lo_{g}"]) / step), F.lit(BINS - 1)) if step > 0 else F.lit(0)).alias(g))
    out = {}
    for r in panel.groupBy("group", *slots).agg(F.count("*").alias("n"), *[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).collect():
        out.setdefault(r["group"], []).append((tuple(r[g] for g in gaps), float(r["n"]), [r[f"c{i}"] for i in range(k)]))
    made = {}
    for g, rows in out.items():
        rows.sort()
        costs = np.array([c for _, _, c in rows])
        made[g] = (np.array([n for _, n, _ in rows]), costs, np.zeros_like(costs))
    return made


def _whole_numbers(loads: np.ndarray, caps: np.ndarray, n: int) -> list[int]:
    """Whole shipments per vehicle, n in all, near the loads and within the capacities."""
    out = np.minimum(np.floor(loads), caps).astype(int)
    for _ in range(n - int(out.sum())):
        room = out < caps
        out[int(np.argmax(np.where(room, loads - out, -np.inf)))] += 1
    return out.tolist()


def _week(cells, n: int, remaining: np.ndarray, share: float, start) -> tuple[list[int], tuple, float]:
    """Shipments per vehicle, prices and smoothing of one week."""
    if remaining.sum() < n:
        raise InfeasiblePlanError(f"{n} shipments in a week, and {int(remaining.sum())} left of the month's capacity")
    caps = np.minimum(np.ceil(remaining * share), remaining)
    while caps.sum() < n:  # the week's own share is too small: it takes of what is left, in proportion
        caps = np.minimum(remaining, np.ceil(caps + (remaining - caps) * (n - caps.sum()) / (remaining - caps).sum()))
    spread = float(cells[0] @ (cells[1].max(1) - cells[1].min(1))) / n or 1e-9
    search = _climb(_Ask({}), len(caps), caps.tolist(), None, n, spread, 1e-9, TIGHTNESS, 400, start, 1e-4, False)
    theta, tau, here, _ = _together([search], lambda asks: _fold_cells(cells, asks))[0]
    return _whole_numbers(here[2][1:], caps.astype(int), n), tuple(map(float, theta)), float(tau)


def _saved(spark, path: str) -> dict:
    try:
        rows = spark.read.schema(STATE).parquet(path).collect()
    except AnalysisException:  # nothing is stored yet
        return {}
    return {(r["month"], r["week"]): r.asDict() for r in rows}


def _save(spark, path: str, rows: list[dict]) -> None:
    if rows:
        spark.createDataFrame([tuple(r[n] for n in ("month", "week", "planned", "before", "after", "prices", "tau")) for r in rows], STATE).coalesce(1).write.mode("append").parquet(path)


def rolling_plan(wide: DataFrame, monthly: dict[str, int], folder: str, day="Full_Date", fleet=P.VEHICLES, penalty=P.SLA_PENALTY) -> RollingPlan:
    """A plan per week under the months' capacities; `wide` is a panel of `build_wide` with a day.

    `wide` is read once for every pass, so it lies over stored rows. The state lies in `folder`; weeks that are there are not planned again. Raises where a month has more shipments than
    capacity.
    """
    spark, k = wide.sparkSession, len(fleet)
    cost = [(F.col(f"f{i}") + penalty * F.col(f"p{i}") if f"p{i}" in wide.columns else F.col(f"f{i}")).alias(f"c{i}") for i in range(k)]
    dated = periods(wide, day).select("Shipment_ID", "month", "week", *cost)
    demand = {(r["month"], r["week"]): r["count"] for r in dated.groupBy("month", "week").count().collect()}  # bounded by the calendar
    order = sorted(demand)
    number = spark.createDataFrame([(m, w, i) for i, (m, w) in enumerate(order)], "g_month string, g_week date, group int")
    panel = dated.join(F.broadcast(number), (F.col("month") == F.col("g_month")) & (F.col("week") == F.col("g_week"))).drop("g_month", "g_week")
    cells, path = _cells_by_period(panel, k), f"{folder}/state"
    state, fresh, made, start, last_saved = _saved(spark, path), [], 0, None, 0
    months = sorted({m for m, _ in order})
    remaining = None
    for g, (month, week) in enumerate(order):
        if g == 0 or order[g - 1][0] != month:
            remaining = np.array([int(monthly.get(v, 0)) for v in fleet])
            if months.index(month) - last_saved >= SAVE_EVERY:
                _save(spark, path, fresh)
                fresh, last_saved = [], months.index(month)
        row = state.get((month, week))
        if row is None or list(row["before"]) != remaining.tolist() or sum(row["planned"]) != demand[month, week]:
            here, left = _days(month, week)
            planned, prices, tau = _week(cells[g], demand[month, week], remaining, here / left, start)
            row = {"month": month, "week": week, "planned": planned, "before": remaining.tolist(), "after": (remaining - planned).tolist(), "prices": list(prices), "tau": tau}
            fresh.append(row)
            made += 1
        state[month, week] = row
        remaining, start = np.array(row["after"]), tuple(row["prices"])
    _save(spark, path, fresh)
    rows = [state[p] for p in order]
    assignment = _drawn(panel, rows, k, fleet)
    weeks = spark.createDataFrame([
        (r["month"], r["week"], v, int(r["planned"][i]), int(r["before"][i]), int(r["after"][i])) for r in rows for i, v in enumerate(fleet)],
        "month string, week date, Vehicle_Type string, planned int, capacity_before int, capacity_after int")
    return RollingPlan(assignment, weeks, made)


def _by_group(values) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("group"))


def _drawn(panel: DataFrame, rows: list[dict], k: int, fleet) -> DataFrame:
    """Every shipment with a vehicle, each week with exactly its numbers."""
    r = [F.col(f"c{i}") + _by_group([float(x["prices"][i + 1]) for x in rows]) for i in range(k)]
    d = panel.select("Shipment_ID", "month", "week", "group", *[x.alias(f"r{i}") for i, x in enumerate(r)])
    d = d.withColumn("m", F.least(*[F.col(f"r{i}") for i in range(k)])).withColumn("tau", _by_group([float(x["tau"]) for x in rows]))
    w = [F.exp((F.col("m") - F.col(f"r{i}")) / F.col("tau")) for i in range(k)]
    upto, pick, u = F.lit(0.0), F.lit(0), uniform(17, F.col("Shipment_ID"))
    for i in range(k - 1):
        upto = upto + w[i]
        pick = pick + (u * sum(w[1:], w[0]) >= upto).cast("int")
    table = materialise(d.select("Shipment_ID", "month", "week", "group", *[f"r{i}" for i in range(k)], pick.alias("pick")), "rolling-picks")
    over = {g: [-x for x in rows[g]["planned"]] for g in range(len(rows))}
    for x in table.groupBy("group", "pick").count().collect():
        over[x["group"]][x["pick"]] += x["count"]
    pick = F.col("pick")
    tie = F.pmod(F.xxhash64("Shipment_ID", F.lit(19)), F.lit(1 << 52)).cast("double")
    while True:
        moves = {}
        for g, o in over.items():
            pair = next(((s, t) for s in range(k) for t in range(k) if o[s] > 0 and o[t] < 0), None)
            if pair:
                moves[g] = (*pair, min(o[pair[0]], -o[pair[1]]))
        if not moves:
            break
        src, dst = (_by_group([moves[g][i] if g in moves else -1 for g in range(len(rows))]) for i in (0, 1))
        each = F.array(*[F.col(f"r{i}") for i in range(k)])
        regret = F.when(pick == src, F.get(each, dst) - F.get(each, src))
        edges = kth_by_group(table.select("group", regret.alias("x")).where("x IS NOT NULL"), {g: m[2] - 1 for g, m in moves.items()})
        edge = _by_group([float(edges[g][0]) if g in edges else None for g in range(len(rows))])
        ties = kth_by_group(table.where(regret == edge).select("group", tie.alias("x")), {g: moves[g][2] - 1 - edges[g][1] for g in moves})
        go = (regret < edge) | ((regret == edge) & (tie <= _by_group([float(ties[g][0]) if g in ties else None for g in range(len(rows))])))
        pick = F.when(F.coalesce(go, F.lit(False)), dst).otherwise(pick)
        table, pick = table.withColumn("pick", pick), F.col("pick")
        for g, (s, t, m) in moves.items():
            over[g][s] -= m
            over[g][t] += m
    return table.select("Shipment_ID", "month", "week", F.get(F.array(*[F.lit(v) for v in fleet]), F.col("pick")).alias("Vehicle_Type"))

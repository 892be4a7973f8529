"""Vehicle allocation under fleet caps and an emission ceiling.

Without a ceiling and with caps that all bind, the cheapest plan is a ranking by ton-km (exact). In
general prices for the ceiling (per kg) and for each vehicle's cap are found on the dual: every pass is
one map-side aggregate over the stored panel, and only a few sums reach the driver. The dual gives a
lower bound; the plan built from the prices gives an upper one, and the gap is always reported.
"""

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError, UnprovenPlanError
from cargolume.functions.keys import spread_key, uniform
from cargolume.operators.ordering import _kth_hash, kth_by_group, kth_values
from cargolume.operators.panels import by_pair, wide_panel
from cargolume.session import literal_rows, materialise


MAX_GAP = 1e-3  # a plan further above its bound than this share is not returned
DRAWS = 6       # draws of whole vehicles before a ceiling is given up
PANEL_INPUTS = ("Distance_km", "Weight_tons", "Weather_Condition", "Traffic_Density")


@dataclass(frozen=True)
class Plan:
    """A plan and its figures; `assignment` has (Shipment_ID, Vehicle_Type, share)."""

    assignment: DataFrame
    freight: float
    co2_kg: float
    counts: dict
    epsilon_kg: float | None = None
    shadow_price_per_ton: float | None = None
    lower_bound: float | None = None
    objective: float | None = None
    expected_delays: float | None = None
    fractional_shipments: int = 0
    prices: tuple | None = None  # carbon and fleet prices, a warm start for a nearby ceiling
    state: str = "proven"        # "unproven": a frontier point whose search ended without a plan

    def meets(self, caps: dict, rows: int, tolerance=1e-6) -> bool:
        """Every shipment is planned, and ceiling and caps hold; caps up to a relative tolerance, for split shipments."""
        if abs(sum(self.counts.values()) - rows) > tolerance * max(rows, 1):
            return False
        # Sums of the same rows in another order differ in their last digits; that is all a ceiling allows.
        inside = self.epsilon_kg is None or self.co2_kg <= self.epsilon_kg * (1 + 1e-12 * max(rows, 1) ** 0.5)
        return inside and all(self.counts.get(v, 0.0) <= c * (1 + tolerance) + tolerance for v, c in caps.items())

    @property
    def gap(self):
        if self.lower_bound is None or not self.objective:
            return None
        return (self.objective - self.lower_bound) / abs(self.objective)


# --- exact minimum freight ------------------------------------------------------------------------

def ranked_assignment(df: DataFrame, caps: dict, rates=None, value="ton_km", key="Shipment_ID") -> DataFrame:
    """Largest ton-km to the lowest rate while the vehicle lasts; exact when the caps sum to the rows.

    Only the boundary values are searched for. The plan itself is an expression per row.
    """
    rates = rates or P.FREIGHT_RATE
    order = sorted(caps, key=lambda v: rates[v])
    n, blank = df.agg(F.count("*"), F.count_if(F.col(value).isNull() | F.isnan(F.col(value).cast("double")))).first()
    if blank:
        raise InfeasiblePlanError(f"{blank} shipments have no {value}")
    if sum(caps.values()) != n:
        raise ValueError(f"the ranking needs caps that sum to the {n} shipments, got {sum(caps.values())}")
    down = df.select(spread_key(key).alias("_tie"), (-F.col(value)).alias("_down"))
    ends = np.cumsum([caps[v] for v in order])[:-1]
    inner = sorted({int(e) for e in ends if 0 < e < n})
    cut = {}
    for end, (edge, below) in zip(inner, kth_values(down, "_down", inner) if inner else []):
        tied = down.where(F.col("_down") == edge)
        cut[end] = (edge, _kth_hash(tied, end - below, tied.count()))
    choice = F.lit(order[0])
    for vehicle, end in zip(order[1:], ends):
        if end >= n:
            continue
        if end == 0:
            choice = F.lit(vehicle)
            continue
        edge, tie = cut[int(end)]
        past = (-F.col(value) > edge) | ((-F.col(value) == edge) & (spread_key(key) >= tie))
        choice = F.when(past, F.lit(vehicle)).otherwise(choice)
    return df.withColumn("Vehicle_Type", choice)


def minimum_freight_plan(shipments: DataFrame, caps: dict) -> DataFrame:
    """(Shipment_ID, Vehicle_Type, share) of the cheapest plan with caps that all bind."""
    work = materialise(shipments.select(
        "Shipment_ID", (F.col("Distance_km") * F.col("Weight_tons")).alias("ton_km")), "tonkm")
    return ranked_assignment(work, caps).select("Shipment_ID", "Vehicle_Type", F.lit(1.0).alias("share"))


# --- dual prices ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class _Ask:
    """One plan to be found: costs are `paid` (freight and expected penalties) times `by_paid` plus emissions times `by_kg`."""

    caps: dict
    epsilon: float | None = None
    by_paid: float = 1.0
    by_kg: float = 0.0
    offset: float = 0.0
    start: tuple | None = None
    edge: bool = False  # at the least emission there is: its price runs off, so it is not polished for long

    def cap(self, fleet, rows):
        return [float(self.caps.get(v, rows)) for v in fleet]


def _fold_prices(k: int, asks: list[tuple], wide: DataFrame) -> list:
    """For each (price vector, smoothing, ask): smoothed value, slopes and curvature; all of them in one pass.

    Prices and smoothing ride in one array literal, so the generated code is the same in every pass.
    """
    ks = range(k)
    options = ", ".join(
        f"struct({j} AS j, {float(tau)!r}D AS tau, {float(a.by_paid)!r}D AS w, {float(a.by_kg + p[0])!r}D AS t0, " + ", ".join(f"{float(x)!r}D AS t{d + 1}" for d, x in enumerate(p[1:])) + ")"
        for j, (p, tau, a) in enumerate(asks))
    e = [f"e{i}" for i in ks]
    base = wide.selectExpr(*e, *[f"b{i}" for i in ks], f"explode(array({options})) AS t")
    base = base.selectExpr("t.j AS j", "t.tau AS tau", *e, *[f"t.w * b{i} + t.t0 * e{i} + t.t{i + 1} AS r{i}" for i in ks])
    base = base.selectExpr("*", f"least({', '.join(f'r{i}' for i in ks)}) AS m")
    base = base.selectExpr("j", "tau", "m", *e, *[f"exp((m - r{i}) / tau) AS w{i}" for i in ks])
    base = base.selectExpr("*", " + ".join(f"w{i}" for i in ks) + " AS w")
    base = base.selectExpr("j", "m - tau * ln(w) AS g", *e, *[f"w{i} / w AS y{i}" for i in ks])
    base = base.selectExpr("*", " + ".join(f"y{i} * e{i}" for i in ks) + " AS eb")
    sums = ["sum(g) AS g", "sum(eb) AS e",
            "sum(" + " + ".join(f"y{i} * (e{i} - eb) * (e{i} - eb)" for i in ks) + ") AS ee"]
    sums += [f"sum(y{i}) AS n{i}" for i in ks] + [f"sum(y{i} * (e{i} - eb)) AS x{i}" for i in ks]
    sums += [f"sum(y{i} * y{l}) AS q{i}_{l}" for i in ks for l in range(i, k)]
    rows = {row["j"]: row for row in base.groupBy("j").agg(*[F.expr(x) for x in sums]).collect()}
    out = []
    for j, (p, tau, _) in enumerate(asks):
        row = rows[j]
        grad = np.array([row["e"]] + [row[f"n{i}"] for i in range(k)])
        hess = np.zeros((k + 1, k + 1))
        hess[0, 0] = row["ee"]
        for i in range(k):
            hess[0, i + 1] = hess[i + 1, 0] = row[f"x{i}"]
            for l in range(i, k):
                q = row[f"q{i}_{l}"]
                hess[i + 1, l + 1] = hess[l + 1, i + 1] = (row[f"n{i}"] if i == l else 0.0) - q
        out.append((p, row["g"], grad, hess / tau))
    return out


CELL_BINS = (96, 48, 16)  # per difference; the first that gives at most CELLS of them
CELLS = 30_000


def _cells(wide: DataFrame, k: int):
    """Panel rows alike in what they pay and emit, as (rows, mean payments, mean emissions) arrays; the same for every ceiling.

    A bounded number reaches the driver, whatever the panel's size: CELLS, or the last of CELL_BINS to the power of 2 (k - 1).
    """
    gaps = {f"{a}_{i}": F.col(f"{a}{i}") - F.col(f"{a}0") for a in "be" for i in range(1, k)}
    spans = wide.agg(*[f(x).alias(f"{n}_{name}") for name, x in gaps.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for bins in CELL_BINS:
        slots = []
        for name, x in gaps.items():
            low, high = spans[f"lo_{name}"] or 0.0, spans[f"hi_{name}"] or 0.0
            step = (high - low) / bins
            slots.append((F.least(F.floor((x - low) / step), F.lit(bins - 1)) if step > 0 else F.lit(0)).alias(name))
        if bins == CELL_BINS[-1] or wide.select(F.xxhash64(*slots).alias("x")).agg(F.approx_count_distinct("x")).first()[0] <= CELLS:
            break
    rows = wide.groupBy(*slots).agg(F.count("*").alias("n"), *[F.avg(f"{a}{i}").alias(f"{a}{i}") for a in "be" for i in range(k)]).collect()
    rows = sorted(rows, key=lambda r: tuple(r[n] for n in gaps))
    return (np.array([float(r["n"]) for r in rows]), *(np.array([[r[f"{a}{i}"] for i in range(k)] for r in rows]) for a in "be"))


def _fold_cells(cells, asks: list[tuple]) -> list:
    """What `_fold_prices` gives, on cells."""
    n, b, e = cells
    out = []
    for p, tau, a in asks:
        reduced = a.by_paid * b + (a.by_kg + p[0]) * e + p[1:]
        least = reduced.min(axis=1, keepdims=True)
        w = np.exp((least - reduced) / tau)
        total = w.sum(axis=1, keepdims=True)
        y = w / total
        value = float(n @ (least - tau * np.log(total))[:, 0])
        moved = np.hstack([(y * e).sum(axis=1, keepdims=True), y])
        k = b.shape[1]
        curve = np.zeros((k + 1, k + 1))
        off = e - moved[:, :1]
        curve[0, 0] = n @ (y * off * off).sum(axis=1)
        curve[0, 1:] = curve[1:, 0] = n @ (y * off)
        curve[1:, 1:] = np.diag(n @ y) - (y * n[:, None]).T @ y
        out.append((p, value, n @ moved, curve / tau))
    return out


def _together(searches: list, fold) -> list:
    """Runs searches side by side and returns their results: what all of them ask in a step is answered in one pass."""
    results, asked = [None] * len(searches), {}

    def go_on(i, answers):
        try:
            asked[i] = searches[i].send(answers)
        except StopIteration as end:
            asked.pop(i, None)
            results[i] = end.value

    for i in range(len(searches)):
        go_on(i, None)
    while asked:
        flat = [(i, x) for i, xs in asked.items() for x in xs]
        answers = fold([x for _, x in flat])
        for i in list(asked):
            go_on(i, [a for (j, _), a in zip(flat, answers) if j == i])
    return results


def dual_prices(wide: DataFrame, asks: list[_Ask], limits: list, rows: int, spreads: list, fleet, cells, tightness=2e-4, passes=80,
                starts=None, exact=1e-10, enough=5e-8) -> list:
    """For every ask (prices, smoothing, sums at them): prices that maximise the smoothed dual, by Newton steps on k + 1 prices.

    A search lowers its smoothing step by step on `cells`, without a job, from its neighbour's result; what is found is
    then polished at the last smoothing on the whole panel. All asks are polished together: a pass is one aggregate for all.
    A search ends at `exact`, the largest share by which a bound is missed; where it gets stuck, `enough` will do.
    """
    k = len(fleet)
    reach = float(cells[0] @ (cells[2].max(axis=1) - cells[2].min(axis=1))) / max(rows, 1) or 1e-9
    near, last = [], None
    for i, a in enumerate(asks):
        start = starts[i] if starts and starts[i] is not None else a.start if a.start is not None else last
        search = _climb(a, k, a.cap(fleet, rows), limits[i], rows, spreads[i], reach, tightness, 2_000, start, exact, False)
        last = tuple(_together([search], lambda x: _fold_cells(cells, x))[0][0])
        near.append(last)

    def polished(a, limit, spread, near):
        # Where few rows are near a switch, or cells are too coarse, the smoothing is lowered step by step on the panel too;
        # but not for draws, which are repaired and held against the bound, whatever the prices.
        for most, from_, final_only in ((5 if a.edge else 25, near, True), (passes, near, False), (passes, None, False))[:1 if a.edge else 2 if enough > 1e-6 else 3]:
            found = yield from _climb(a, k, a.cap(fleet, rows), limit, rows, spread, reach, tightness, most, from_, exact, final_only, enough)
            if found[-1]:
                break
        return found[:-1]

    return _together([polished(a, limits[i], spreads[i], near[i]) for i, a in enumerate(asks)], lambda x: _fold_prices(k, x, wide))


def _climb(ask, k, caps, epsilon, rows, spread, reach, tightness, passes, start, exact, final_only, enough=5e-8):
    """A search that yields lists of (prices, smoothing, ask) and is sent what `_fold_prices` says of them."""
    right = np.array([0.0 if epsilon is None else epsilon, *caps])
    binding = sum(caps) == rows  # all caps bind: fleet prices may take any sign, and one is a free choice
    free_sign = np.array([False] + [binding] * k)
    held = np.array([epsilon is None] + [binding and i == 0 for i in range(k)])
    theta = np.zeros(k + 1) if start is None else np.where(held & (np.arange(k + 1) == 0), 0.0, np.array(start))
    last = max(spread * tightness, 1e-12)
    tau = last if final_only else max(spread, 1e-9) if start is None else max(spread / 50.0, last)
    used = 0
    while True:
        here = (yield [(theta, tau, ask)])[0]
        used += 1
        value = here[1] - theta @ right
        final, radius = tau <= last, 20.0
        for _ in range(25):
            theta, _, used_up, curve = here
            slope = used_up - right
            fixed = held | (~free_sign & (theta <= 0) & (slope < 0))
            scale = np.where(np.arange(k + 1) == 0, max(abs(right[0]), 1.0), float(rows))
            open_slope = np.where(fixed, 0.0, slope)
            if np.max(np.abs(open_slope) / scale) < (exact if final else 1e-3):
                break
            live = np.flatnonzero(~fixed)
            # In units of the smoothing every price has the same reach. Where few shipments are near a
            # switch the curve is almost flat, so the step is held within a trust radius.
            unit = np.array([tau / reach, *([tau] * k)])[live]
            h = curve[np.ix_(live, live)] * np.outer(unit, unit)
            h = h + 1e-9 * rows * tau * np.eye(len(live))
            raw = np.linalg.solve(h, slope[live] * unit)
            raw = raw * min(1.0, radius / max(np.max(np.abs(raw)), 1e-300))
            step = np.zeros(k + 1)
            step[live] = raw * unit
            tries = []
            for t in (1.0, 0.3, 0.05):
                p = theta + t * step
                tries.append((np.where(free_sign, p, np.maximum(p, 0.0)), tau, ask))
            found = yield tries[:1]
            used += 1
            # The dual is concave: no shorter step can gain more than the slope here allows it.
            if found[0][1] - found[0][0] @ right < max(value + slope @ (p - theta) for p, _, _ in tries[1:]):
                found = found + (yield tries[1:])
            best = max(found, key=lambda x: x[1] - x[0] @ right)
            gained = best[1] - best[0] @ right
            if gained <= value + 1e-13 * abs(value):
                if radius < 1e-3:
                    break
                radius /= 30.0  # too long a step: try closer before giving up
            else:
                here, value, radius = best, gained, min(radius * 2.0, 20.0)
            if used >= passes:
                break
        theta = here[0]
        if final or used >= passes:
            slope = here[2] - right
            rest = np.where(held | (~free_sign & (theta <= 0) & (slope < 0)), 0.0, slope)
            return theta, tau, here, final and np.max(np.abs(rest) / scale) < enough
        tau = max(tau / 12.0, last)


def _reduced(k, ask, theta):
    return [float(ask.by_paid) * F.col(f"b{i}") + float(ask.by_kg + theta[0]) * F.col(f"e{i}") + float(theta[i + 1]) for i in range(k)]


def _share_columns(k, ask, theta, tau) -> list:
    """The shares of the vehicles in a row, as expressions."""
    r = _reduced(k, ask, theta)
    least = F.least(*r)
    w = [F.exp((least - x) / tau) for x in r]
    total = reduce(lambda a, b: a + b, w)
    return [x / total for x in w]


def _of(pick, name, k):
    """The value that a row has for the vehicle that is picked."""
    return F.get(F.array(*[F.col(f"{name}{i}") for i in range(k)]), pick)


class _Whole:
    """One vehicle per shipment for several asks at once: drawn from the shares by a repeatable uniform, repaired to the caps.

    The draws of all asks stand side by side in one table, `pick0`, `pick1`, ...; repairs are expressions over it. With
    several asks it is stored; the draw of one ask costs less to make again in every pass than to write with its panel.
    """

    def __init__(self, wide, asks, found, fleet, rows, seed=7):
        self.k, self.asks, self.found, self.fleet = len(fleet), asks, found, fleet
        picks, u = [], uniform(seed, F.col("Shipment_ID"))
        for j, (a, (theta, tau, _)) in enumerate(zip(asks, found)):
            upto, pick = F.lit(0.0), F.lit(0)
            for y in _share_columns(self.k, a, theta, tau)[:-1]:
                upto = upto + y
                pick = pick + (u >= upto).cast("int")
            picks.append(pick.alias(f"pick{j}"))
        drawn = wide.select(*wide.columns, *picks)
        self.table = drawn if len(asks) == 1 else materialise(drawn, "picks")
        self.picks = [F.col(f"pick{j}") for j in range(len(asks))]
        over = [dict.fromkeys(range(self.k), 0.0) for _ in asks]
        for r in self._each(lambda j: self.picks[j]).groupBy("j", "pick").count().collect():
            over[r["j"]][r["pick"]] = r["count"]
        for j, a in enumerate(asks):
            for i, cap in enumerate(a.cap(fleet, rows)):
                over[j][i] -= cap
        self._repair(over)

    def _each(self, pick):
        """A row per shipment and ask: j, pick and the values of the vehicle picked."""
        rows = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), pick(j).cast("int").alias("pick")) for j in range(len(self.asks))]))
        return self.table.select(*[c for c in self.table.columns if c[0] in "befp" and c[1:].isdigit()], rows.alias("x")).select("*", "x.j", "x.pick")

    def _repair(self, over):
        """Shifts exactly what is over from one vehicle to another, least regret first; one move of every ask at a time."""
        while True:
            moves = {}
            for j, o in enumerate(over):
                pair = next(((s, d) for s in range(self.k) for d in range(self.k) if o[s] >= 1 and o[d] <= -1), None)
                if pair:
                    moves[j] = (*pair, int(min(o[pair[0]], -o[pair[1]])))
            if not moves:
                return
            regret = {}
            for j, (src, dst, _) in moves.items():
                r = _reduced(self.k, self.asks[j], self.found[j][0])
                regret[j] = r[dst] - r[src]
            tie = F.pmod(F.xxhash64("Shipment_ID", F.lit(13)), F.lit(1 << 52)).cast("double")

            def rows(value, also):
                each = [F.when((self.picks[j] == src) & also(j), F.struct(F.lit(j).alias("group"), value(j).alias("x"))) for j, (src, _, _) in moves.items()]
                return self.table.select(F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x")).select("x.*")

            edges = kth_by_group(rows(lambda j: regret[j], lambda j: F.lit(True)), {j: m - 1 for j, (_, _, m) in moves.items()})
            ties = kth_by_group(rows(lambda j: tie, lambda j: regret[j] == edges[j][0]), {j: m - 1 - edges[j][1] for j, (_, _, m) in moves.items()})
            for j, (src, dst, m) in moves.items():
                go = (self.picks[j] == src) & ((regret[j] < edges[j][0]) | ((regret[j] == edges[j][0]) & (tie <= ties[j][0])))
                self.picks[j] = F.when(go, F.lit(dst)).otherwise(self.picks[j])
                over[j][src] -= m
                over[j][dst] += m

    def sums(self, risk):
        """Per ask: what it pays, emits, costs in freight, is expected late, and its shipments per vehicle."""
        rows = self._each(lambda j: self.picks[j])
        value = lambda n: _of(F.col("pick"), n, self.k)
        out = rows.groupBy("j").agg(
            F.sum(value("b")).alias("b"), F.sum(value("e")).alias("e"), F.sum(value("f")).alias("f"),
            (F.sum(value("p")) if risk else F.lit(None).cast("double")).alias("p"), *[F.count_if(F.col("pick") == i).alias(f"n{i}") for i in range(self.k)])
        return {r["j"]: r for r in out.collect()}

    def assignment(self, j):
        names = F.get(F.array(*[F.lit(v) for v in self.fleet]), self.picks[j])
        return self.table.select("Shipment_ID", names.alias("Vehicle_Type"), F.lit(1.0).alias("share"))


class _Missed(Exception):
    """No whole plan met the ceiling; carries the bound and the prices."""

    def __init__(self, lower, theta):
        self.lower, self.theta = lower, theta


def _solve(wide, asks: list[_Ask], rows, spreads, fleet, risk, whole, tightness) -> list:
    """A Plan with both bounds for every ask, or a _Missed."""
    k = len(fleet)
    cells = _cells(wide, k)
    # Shares meet their target up to the search's tolerance, and a ceiling is hard.
    limits = [a.epsilon if a.epsilon is None or whole else a.epsilon * (1 - 1e-7) for a in asks]
    out, lower, shadow, starts = [None] * len(asks), [None] * len(asks), [None] * len(asks), [None] * len(asks)
    open_ = list(range(len(asks)))
    for attempt in range(DRAWS):
        mine = [asks[i] for i in open_]
        found = dual_prices(wide, mine, [limits[i] for i in open_], rows, [spreads[i] for i in open_], fleet, cells, tightness,
                            starts=[starts[i] for i in open_], exact=3e-5 if whole else 1e-10, enough=1e-3 if whole else 5e-8)  # draws are repaired
        if attempt == 0:
            hard = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.least(*_reduced(k, a, theta)).alias("x")) for j, (a, (theta, _, _)) in enumerate(zip(mine, found))]))
            for r in wide.select(hard.alias("x")).select("x.*").groupBy("j").agg(F.sum("x").alias("x")).collect():
                a, theta = asks[r["j"]], found[r["j"]][0]
                lower[r["j"]] = r["x"] - float(theta @ np.array([a.epsilon or 0.0, *a.cap(fleet, rows)])) - a.offset
                shadow[r["j"]] = None if a.epsilon is None else float(theta[0]) * 1000.0
        if not whole:
            return [_shared(wide, k, a, f, lower[i], shadow[i], fleet, risk) for i, (a, f) in enumerate(zip(asks, found))]
        drawn = _Whole(wide, mine, found, fleet, rows, seed=7 + attempt)
        sums, again, floor = drawn.sums(risk), [], None
        for j, i in enumerate(open_):
            a, (theta, tau, (_, _, _, curve)), s = asks[i], found[j], sums[j]
            starts[i] = tuple(map(float, theta))
            if a.epsilon is None or s["e"] <= a.epsilon:
                plan = Plan(drawn.assignment(j), s["f"], s["e"], {v: float(s[f"n{x}"]) for x, v in enumerate(fleet)}, a.epsilon, shadow[i],
                            lower[i], a.by_paid * s["b"] + a.by_kg * s["e"] - a.offset, s["p"], 0, starts[i])
                if out[i] is None or plan.objective < out[i].objective:
                    out[i] = plan
                if out[i].gap > MAX_GAP:
                    again.append(i)
                continue
            # Drawing whole vehicles misses the ceiling by chance: aim lower by what it missed, or by what it may.
            noise = float(np.sqrt(max(curve[0, 0] * tau, 0.0)))
            lowered = limits[i] - 0.5 * max(s["e"] - a.epsilon, noise) * (attempt + 1)
            floor = wide.agg(F.sum(F.least(*[F.col(f"e{x}") for x in range(k)]))).first()[0] if floor is None else floor
            if out[i] is None and lowered > floor and not a.edge:
                limits[i] = lowered
                again.append(i)
        open_ = again
        if not open_:
            break
    return [_Missed(lower[i], np.array(starts[i])) if p is None else p for i, p in enumerate(out)]


def _shared(wide, k, ask, found, lower, shadow, fleet, risk) -> Plan:
    """The plan of the shares themselves, which may split a shipment between vehicles."""
    theta, tau, _ = found
    df = wide.select("*", *[y.alias(f"y{i}") for i, y in enumerate(_share_columns(k, ask, theta, tau))])
    y = [F.col(f"y{i}") for i in range(k)]

    def dot(name):
        return F.sum(reduce(lambda a, b: a + b, [y[i] * F.col(f"{name}{i}") for i in range(k)]))

    sums = df.agg(dot("b").alias("b"), dot("e").alias("e"), dot("f").alias("f"), (dot("p") if risk else F.lit(None)).alias("p"),
                  F.count_if(F.greatest(*y) < 1 - 1e-6).alias("split"), *[F.sum(y[i]).alias(f"n{i}") for i in range(k)]).first()
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("v"), y[i].alias("s")) for i, v in enumerate(fleet)]))
    assignment = df.select("Shipment_ID", pairs.alias("x")).select(
        "Shipment_ID", F.col("x.v").alias("Vehicle_Type"), F.col("x.s").alias("share")).where("share > 1e-9")
    return Plan(assignment, sums["f"], sums["e"], {v: sums[f"n{i}"] for i, v in enumerate(fleet)}, ask.epsilon, shadow,
                lower, ask.by_paid * sums["b"] + ask.by_kg * sums["e"] - ask.offset, sums["p"], int(sums["split"]), tuple(map(float, theta)))


@dataclass(frozen=True)
class _Stats:
    """Rows, and of payments and emissions the mean range over the vehicles; the total range of emissions."""

    rows: int
    paid: float
    kg: float
    span: float

    def spread(self, ask):
        return ask.by_paid * self.paid + ask.by_kg * self.kg


def _priced(wide, penalty, k):
    """The panel with b0.., what a shipment pays on each vehicle, and its `_Stats`."""
    risk = "p0" in wide.columns
    priced = wide.select("*", *[(F.col(f"f{i}") + penalty * F.col(f"p{i}") if risk else F.col(f"f{i}")).alias(f"b{i}") for i in range(k)])

    def gap(name):
        cols = [F.col(f"{name}{i}") for i in range(k)]
        return F.greatest(*cols) - F.least(*cols)

    row = priced.agg(F.count("*"), F.avg(gap("b")), F.avg(gap("e")), F.sum(gap("e"))).first()
    return priced, _Stats(row[0], *[float(x or 0.0) for x in row[1:]])


def panel_inputs(shipments: DataFrame, risk=None, keep=()) -> DataFrame:
    """Shipment_ID, what emissions and freight follow from, `risk` and the columns to keep, stored: a third of the panel's bytes."""
    return materialise(shipments.select("Shipment_ID", *[c for c in PANEL_INPUTS if c not in keep], *(risk or ()), *keep), "panel", spread=True)


def widened(rows: DataFrame, fleet=P.VEHICLES, keep=()) -> DataFrame:
    """The panel over stored `panel_inputs`, computed in every pass; p0.. columns and those to keep stay."""
    risk = [c for c in rows.columns if c[0] == "p" and c[1:].isdigit()]
    wide = wide_panel(rows, fleet, keep=[*risk, *keep])
    faults = panel_faults(wide).first()
    if any(faults):
        raise InfeasiblePlanError(f"shipments without emission, freight or risk for some vehicle: {faults.asDict()}")
    return wide


def build_wide(shipments: DataFrame, risk=None, fleet=P.VEHICLES) -> DataFrame:
    """The panel over stored inputs; `risk` gives the p0.. columns of risk_columns()."""
    return widened(panel_inputs(shipments, risk), fleet)


def panel_faults(wide: DataFrame) -> DataFrame:
    """Rows of a wide panel whose emission, freight or probability is missing for some vehicle."""
    def blank(letter):
        cols = [F.col(c) for c in wide.columns if c[0] == letter and c[1:].isdigit()]
        return reduce(lambda a, b: a | b, [c.isNull() | F.isnan(c) for c in cols], F.lit(False))

    return wide.agg(F.count_if(blank("e")).alias("no_emission"), F.count_if(blank("f")).alias("no_freight"),
                    F.count_if(blank("p")).alias("no_risk"))


GREENEST = {"by_paid": 0.0, "by_kg": 1.0}


def minimum_emission_plan(wide: DataFrame, caps: dict, fleet=P.VEHICLES, whole=True, tightness=2e-4) -> Plan:
    """The greenest plan that the caps allow, cost ignored."""
    priced, stats = _priced(wide, 0.0, len(fleet))
    _require_room(caps, stats.rows, fleet)
    ask = _Ask(caps, **GREENEST)
    plan = _solve(priced, [ask], stats.rows, [stats.spread(ask)], fleet, "p0" in wide.columns, whole, tightness)[0]
    return _green(plan, caps, stats.rows)


def _green(plan, caps, rows):
    if isinstance(plan, _Missed) or not plan.meets(caps, rows):
        raise UnprovenPlanError("no plan was found that meets the caps")
    return _proven(plan)


def _proven(plan: Plan, most=MAX_GAP) -> Plan:
    if plan.gap is not None and plan.gap > most:
        raise UnprovenPlanError(f"the best plan found costs {plan.objective:.2f}, the bound is {plan.lower_bound:.2f}: a gap of {plan.gap:.2e}")
    return plan


def _require_room(caps, rows, fleet):
    room = sum(caps.get(v, rows) for v in fleet)
    if room < rows:
        raise InfeasiblePlanError(f"the caps hold {room} of {rows} shipments")


def _ceiling(caps, epsilon, stats, greenest, start=None) -> _Ask:
    """The ask for a plan under a ceiling; raises where the greenest plan shows that there is none."""
    if epsilon < greenest.co2_kg * (1 - 1e-12):  # else the greenest plan itself meets it, whatever the last digits of the bound
        if epsilon < greenest.lower_bound * (1 - 1e-9):
            raise InfeasiblePlanError(f"the ceiling {epsilon:.1f} kg is below {greenest.lower_bound:.1f} kg, the least that the caps allow")
        raise UnprovenPlanError(f"the ceiling {epsilon:.1f} kg lies between the bound {greenest.lower_bound:.1f} and the best plan found, {greenest.co2_kg:.1f}")
    # Ties go to the lower emission. The tie-break rewards room under the ceiling, so the bound also holds for the cost without it.
    delta = P.SLACK_WEIGHT / stats.span if stats.span else 0.0
    return _Ask(caps, epsilon, 1.0, delta, delta * epsilon, start, epsilon <= greenest.co2_kg * (1 + 1e-6))


def _settled(found, ask, rows, greenest, risk, penalty) -> Plan:
    """The plan that was found, or the greenest where no other meets the ceiling; proven, or an error."""
    if not isinstance(found, _Missed):
        if found.meets(ask.caps, rows):
            # At the greenest end a price has no meaning: no money buys a lower ceiling.
            edge = ask.epsilon is not None and ask.epsilon <= greenest.lower_bound * (1 + 1e-6)
            return _proven(replace(found, shadow_price_per_ton=None) if edge else found)
        lower, prices = found.lower_bound, found.prices
    else:
        lower, prices = found.lower, tuple(map(float, found.theta))
    if greenest is None or not greenest.meets(ask.caps, rows):
        raise UnprovenPlanError(f"no plan was found that meets caps and ceiling; the bound is {lower:.2f}")
    # At the very edge the prices run off, so none is reported; the greenest plan fits, and the bound still holds.
    paid = greenest.freight + (penalty * greenest.expected_delays if risk else 0.0)
    return _proven(replace(greenest, epsilon_kg=ask.epsilon, lower_bound=min(lower, paid), objective=paid,
                           shadow_price_per_ton=None, prices=prices))


def allocate(wide: DataFrame, caps: dict, epsilon_kg: float | None = None, penalty=P.SLA_PENALTY,
             fleet=P.VEHICLES, whole=True, tightness=2e-4, greenest: Plan | None = None,
             start=None) -> Plan:
    """Cheapest plan under the caps and the emission ceiling; p0.. columns add the expected late penalty.

    `whole=False` returns shares, which may split a shipment between vehicles.
    """
    risk = "p0" in wide.columns
    priced, stats = _priced(wide, penalty, len(fleet))
    _require_room(caps, stats.rows, fleet)
    if epsilon_kg is None:
        ask = _Ask(caps, start=start)
    else:
        greenest = greenest or minimum_emission_plan(wide, caps, fleet, whole, tightness)
        ask = _ceiling(caps, epsilon_kg, stats, greenest, start)
    found = _solve(priced, [ask], stats.rows, [stats.spread(ask)], fleet, risk, whole, tightness)[0]
    return _settled(found, ask, stats.rows, greenest, risk, penalty)


def frontier(wide: DataFrame, caps: dict, points=12, fleet=P.VEHICLES, whole=True, tightness=2e-4, penalty=P.SLA_PENALTY) -> list[Plan]:
    """Plans at ceilings from the cheapest plan's emissions down to the greenest plan's, all found together.

    Two solves: both ends, then every ceiling. In a solve all prices are searched in the same passes over the panel.
    """
    risk = "p0" in wide.columns
    priced, stats = _priced(wide, penalty, len(fleet))
    _require_room(caps, stats.rows, fleet)
    ends = [_Ask(caps), _Ask(caps, **GREENEST)]
    cheapest, greenest = _solve(priced, ends, stats.rows, [stats.spread(a) for a in ends], fleet, risk, whole, tightness)
    cheapest, greenest = _settled(cheapest, ends[0], stats.rows, None, risk, penalty), _green(greenest, caps, stats.rows)
    asks, plans = [], []
    for step in range(points):
        ceiling = cheapest.co2_kg - (cheapest.co2_kg - greenest.co2_kg) * step / max(points - 1, 1)
        asks.append(_ceiling(caps, max(ceiling, greenest.co2_kg), stats, greenest, cheapest.prices if step == 0 else None))
    for ask, found in zip(asks, _solve(priced, asks, stats.rows, [stats.spread(a) for a in asks], fleet, risk, whole, tightness)):
        try:
            plans.append(_settled(found, ask, stats.rows, greenest, risk, penalty))
        except UnprovenPlanError:
            plans.append(Plan(None, None, None, {}, ask.epsilon, state="unproven"))
    return plans


def frontier_table(spark, plans: list[Plan]) -> DataFrame:
    """One row per ceiling; an unproven point has its state and no figures."""
    names = ["epsilon_kg", "freight", "co2_kg", "shadow_price_per_ton", "lower_bound", "gap"]
    table = literal_rows(spark, [*names, "state"], [(*[getattr(p, n) for n in names], p.state) for p in plans])
    return table.select(*[F.col(n).cast("double").alias(n) for n in names], "state")


def marginal_abatement(points: DataFrame) -> DataFrame:
    """Cost of the next kg saved between neighbouring ceilings; one row per point, a short list."""
    w = Window.orderBy(F.desc("epsilon_kg"))
    saved = F.lag("epsilon_kg").over(w) - F.col("epsilon_kg")
    return points.withColumn("marginal_cost_per_kg", F.try_divide(F.col("freight") - F.lag("freight").over(w), saved))


def carbon_price_sweep(wide: DataFrame, prices_per_ton, fleet=P.VEHICLES) -> DataFrame:
    """Totals when every shipment takes its cheapest vehicle at a carbon price, without caps; one pass."""
    k = len(fleet)
    priced = wide.withColumn("price_per_ton", F.explode(F.array(*[F.lit(float(p)) for p in prices_per_ton])))
    cost = [F.col(f"f{i}") + F.col("price_per_ton") / 1000.0 * F.col(f"e{i}") for i in range(k)]
    best = F.least(*[F.struct(c.alias("c"), F.lit(i).alias("i")) for i, c in enumerate(cost)])
    picked = priced.withColumn("pick", best["i"])
    return picked.groupBy("price_per_ton").agg(
        F.sum(_of(F.col("pick"), "f", k)).alias("freight"), F.sum(_of(F.col("pick"), "e", k)).alias("co2_kg"),
        *[F.count_if(F.col("pick") == i).alias("n_" + v.lower().replace(" ", "_")) for i, v in enumerate(fleet)])


def plan_summary(assignment: DataFrame, panel: DataFrame) -> DataFrame:
    """Counts, freight, CO2, expected late and split shipments per vehicle."""
    joined = by_pair(assignment, panel)
    late = F.sum(F.col("p") * F.col("share")) if "p" in panel.columns else F.lit(None).cast("double")
    return joined.groupBy("Vehicle_Type").agg(
        F.sum("share").alias("shipments"), F.sum(F.col("freight") * F.col("share")).alias("freight"),
        F.sum(F.col("co2_kg") * F.col("share")).alias("co2_kg"), late.alias("expected_late"),
        F.count_if(F.col("share") < 1 - 1e-6).alias("split_rows"))


def abatement(quo: DataFrame, plan: DataFrame) -> DataFrame:
    """Plan against status quo from their per-vehicle summaries."""
    def total(df, c):
        return df.agg(F.sum(c)).scalar()

    base = quo.agg(F.sum("co2_kg").alias("quo_co2_kg"), F.sum("freight").alias("quo_freight"))
    out = base.withColumn("plan_co2_kg", total(plan, "co2_kg")).withColumn("plan_freight", total(plan, "freight"))
    return out.select("*", (F.col("quo_co2_kg") - F.col("plan_co2_kg")).alias("saved_kg"),
                      (100.0 * F.try_divide(F.col("plan_co2_kg") - F.col("quo_co2_kg"), F.col("quo_co2_kg"))).alias("change_percent"),
                      (F.col("quo_freight") - F.col("plan_freight")).alias("saved_freight"))


__all__ = ["Plan", "abatement", "allocate", "build_wide", "carbon_price_sweep", "dual_prices", "frontier",
           "frontier_table", "marginal_abatement", "minimum_emission_plan", "minimum_freight_plan", "panel_inputs", "plan_summary",
           "ranked_assignment", "widened"]

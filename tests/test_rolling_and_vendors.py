"""Plans per week and vendor shares."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import InfeasiblePlanError
from cargolume.operators import allocation as al
from cargolume.operators import panels, rolling
from cargolume.operators import vendors as vd
from cargolume.session import fresh_path


@pytest.fixture(scope="module")
def wide(view):
    rows = view.where("Shipment_Date < '1996-01-01'").withColumn("Full_Date", F.to_date("Shipment_Date"))
    made = al.build_wide(rows)
    return made.join(rows.select("Shipment_ID", "Full_Date"), "Shipment_ID"), rows


@pytest.fixture(scope="module")
def monthly(wide):
    most = wide[1].groupBy(F.date_format("Full_Date", "yyyy-MM")).count().agg(F.max("count")).first()[0]
    return {v: int(np.ceil(most * s)) for v, s in zip(P.VEHICLES, (0.5, 0.3, 0.4))}


def test_running_budget_holds_every_week(spark, wide, monthly):
    folder = fresh_path(spark, "rolling")
    plan = rolling.rolling_plan(wide[0], monthly, folder)
    rows = plan.assignment.collect()
    assert sorted(r["Shipment_ID"] for r in rows) == sorted(r[0] for r in wide[1].select("Shipment_ID").collect())
    used, weeks = {}, sorted(plan.weeks.collect())
    planned = {(r["month"], r["week"], r["Vehicle_Type"]): r["planned"] for r in weeks}
    for r in rows:
        key = (r["month"], r["week"], r["Vehicle_Type"])
        used[key] = used.get(key, 0) + 1
    assert used == {k: n for k, n in planned.items() if n}
    left = {}
    for r in weeks:
        key = (r["month"], r["Vehicle_Type"])
        assert r["capacity_before"] == left.get(key, monthly[r["Vehicle_Type"]]) and r["capacity_after"] == r["capacity_before"] - r["planned"] >= 0
        left[key] = r["capacity_after"]
    assert plan.planned_now == len({(r["month"], r["week"]) for r in weeks})
    again = rolling.rolling_plan(wide[0], monthly, folder)  # all weeks are in the stored state
    assert again.planned_now == 0 and sorted(map(tuple, again.assignment.collect())) == sorted(map(tuple, rows))


def test_a_lost_run_goes_on(spark, wide, monthly, monkeypatch):
    """The run stops in the fifth month; what it had stored is not planned again, and the plan is the same."""
    whole = rolling.rolling_plan(wide[0], monthly, fresh_path(spark, "rolling"))
    folder, calls, plain = fresh_path(spark, "rolling"), [], rolling._week
    monkeypatch.setattr(rolling, "SAVE_EVERY", 1)

    def week(*a):
        calls.append(1)
        if len(calls) == 22:
            raise RuntimeError("lost")
        return plain(*a)

    monkeypatch.setattr(rolling, "_week", week)
    with pytest.raises(RuntimeError, match="lost"):
        rolling.rolling_plan(wide[0], monthly, folder)
    monkeypatch.setattr(rolling, "_week", plain)
    rest = rolling.rolling_plan(wide[0], monthly, folder)
    assert 0 < rest.planned_now < whole.planned_now
    assert sorted(map(tuple, rest.weeks.collect())) == sorted(map(tuple, whole.weeks.collect()))


def test_month_without_room_raises(spark, wide, monthly):
    with pytest.raises(InfeasiblePlanError, match="left of the month"):
        rolling.rolling_plan(wide[0], {v: 3 for v in monthly}, fresh_path(spark, "rolling"))


def test_week_takes_the_cheapest_within_its_share():
    cells = (np.array([10.0, 10.0]), np.array([[1.0, 5.0], [1.0, 2.0]]), np.zeros((2, 2)))
    planned, *_ = rolling._week(cells, 20, np.array([12, 40]), 1.0, None)
    assert planned == [12, 8]
    assert rolling._whole_numbers(np.array([3.6, 2.4]), np.array([3, 9]), 6) == [3, 3]


def some_vendors(rows, n=25, cap=1.3, floor=0.4):
    share = rows / n
    return [vd.Vendor(f"V{j:02d}", 1.5 + 3.4 * j / (n - 1), 0.85 + 0.3 * j / (n - 1), float(np.ceil(cap * share)), float(np.floor(floor * share))) for j in range(n)]


def check(plan, vendors, n, service=None):
    totals = plan.assignment.groupBy("Shipment_ID").agg(F.sum("share").alias("s"))
    assert totals.count() == n and totals.where("abs(s - 1) > 1e-9").count() == 0
    for v in vendors:
        assert v.floor * (1 - 1e-6) <= plan.loads[v.id] <= v.cap * (1 + 1e-6)
    assert service is None or plan.expected_late <= service * n
    assert -1e-9 <= plan.gap <= 1e-3


def test_vendor_bounds_and_service_level(wide):
    rows = wide[1]
    n = rows.count()
    vendors = some_vendors(n)
    free = vd.assign_vendors(rows, vendors, offset=-2.7)
    check(free, vendors, n)
    service = 0.97 * free.expected_late / n
    tight = vd.assign_vendors(rows, vendors, offset=-2.7, service=service)
    check(tight, vendors, n, service)
    assert tight.late_price > 0 and tight.lower_bound >= free.lower_bound - 1e-6 and free.late_price == 0


def test_capacity_does_the_work(wide):
    """Without capacities and floors every shipment goes to its cheapest vendor; with them it costs more."""
    rows = wide[1].limit(400).cache()
    vendors = some_vendors(400)
    roomy = [vd.Vendor(v.id, v.rating, v.rate, 1e6) for v in vendors]
    terms = vd.base_terms(rows).collect()
    best = sum(min(t["freight"] * v.rate + P.SLA_PENALTY / (1 + np.exp(-(t["z"] - 2.7 + t["amp"] * (P.VENDOR_CENTRE - v.rating)))) for v in vendors) for t in terms)
    plan = vd.assign_vendors(rows, roomy, offset=-2.7)
    assert plan.lower_bound == pytest.approx(best, rel=1e-9) and set(plan.prices.values()) == {0.0}
    assert vd.assign_vendors(rows, vendors, offset=-2.7).lower_bound > plan.lower_bound


def test_bound_lies_below_every_whole_plan(spark, wide):
    rows = spark.createDataFrame(wide[1].orderBy("Shipment_ID").limit(6).collect(), wide[1].schema)
    vendors = [vd.Vendor("a", 4.8, 1.1, 2, 1), vd.Vendor("b", 3.0, 0.95, 3, 0), vd.Vendor("c", 1.5, 0.8, 4, 2)]
    terms = vd.base_terms(rows).collect()
    cost = [[t["freight"] * v.rate + P.SLA_PENALTY / (1 + np.exp(-(t["z"] - 2.7 + t["amp"] * (P.VENDOR_CENTRE - v.rating)))) for v in vendors] for t in terms]
    best = min(sum(c[j] for c, j in zip(cost, p)) for p in itertools.product(range(3), repeat=6) if all(v.floor <= p.count(j) <= v.cap for j, v in enumerate(vendors)))
    plan = vd.assign_vendors(rows, vendors, offset=-2.7)
    assert plan.lower_bound <= best + 1e-6 and plan.cost <= best * (1 + 2e-3)


def test_no_room_raises(wide):
    with pytest.raises(InfeasiblePlanError, match="no room"):
        vd.assign_vendors(wide[1], [vd.Vendor("a", 4.0, 1.0, 5.0)])
    assert panels.caps_dict(panels.observed_caps(wide[1]))

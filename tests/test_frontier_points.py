"""The frontier's ceilings, found together, against single solves."""

import pytest
from pyspark.sql import functions as F

from cargolume.operators import allocation as al
from cargolume.operators import panels
from cargolume.operators.ordering import kth_by_group


@pytest.fixture(scope="module")
def panel(view):
    rows = view.where("Shipment_Date < '1996-01-01'")
    return al.build_wide(rows), panels.caps_dict(panels.observed_caps(rows))


@pytest.fixture(scope="module")
def plans(panel):
    return al.frontier(*panel)


def test_twelve_ceilings_by_default(panel, plans):
    wide, caps = panel
    n, (low, high) = wide.count(), (min(p.epsilon_kg for p in plans), max(p.epsilon_kg for p in plans))
    assert len(plans) == 12 and [p.state for p in plans] == ["proven"] * 12
    assert [p.epsilon_kg for p in plans] == pytest.approx([high - (high - low) * k / 11 for k in range(12)])
    for p in plans:
        assert p.meets(caps, n) and -1e-9 < p.gap <= 1e-3
        assert p.assignment.count() == n == p.assignment.select("Shipment_ID").distinct().count()
        assert {r["Vehicle_Type"]: r["count"] for r in p.assignment.groupBy("Vehicle_Type").count().collect()} == {v: c for v, c in p.counts.items() if c}


def test_points_equal_single_solves(panel, plans):
    wide, caps = panel
    green = al.minimum_emission_plan(wide, caps)
    for p in plans[2:11:4]:
        alone = al.allocate(wide, caps, p.epsilon_kg, greenest=green)
        assert p.lower_bound == pytest.approx(alone.lower_bound, rel=1e-5) and p.freight == pytest.approx(alone.freight, rel=2e-3)


def test_a_pass_serves_all_searches():
    calls = []

    def search(n):
        total = 0
        for k in range(n):
            total += sum((yield [k, k + 1]))
        return total

    assert al._together([search(3), search(1), search(0)], lambda asks: calls.append(len(asks)) or asks) == [9, 1, 0]
    assert calls == [4, 2, 2]


@pytest.mark.parametrize("pick", [2, 5_000])
def test_order_statistics_by_group(spark, pick):
    values = {0: [float(k % 7) for k in range(300)], 1: [k * 1e-9 for k in range(50)], 2: [5.0] * 40, 3: [1.0]}
    rows = spark.createDataFrame([(g, x) for g, xs in values.items() for x in xs], "group int, x double")
    for ranks in ({0: 0, 1: 49, 2: 39, 3: 0}, {0: 150, 1: 20}, {0: 299}):
        got = kth_by_group(rows, ranks, pick_rows=pick, bins=8)
        for g, k in ranks.items():
            want = sorted(values[g])[k]
            assert got[g] == (want, sum(x < want for x in values[g]))
    with pytest.raises(ValueError, match="rank 40"):
        kth_by_group(rows, {2: 40})
    assert rows.where(F.col("group") == 9).count() == 0
    with pytest.raises(ValueError, match="group 9"):
        kth_by_group(rows, {9: 0})

import itertools
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import UnknownCategoryError
from cargolume.functions import formulas as fx
from cargolume.functions import generators as gen
from cargolume.functions.calendar import date_id, season
from cargolume.functions.keys import route_key


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def shipment(spark, d=450.0, w=12.0, v="Diesel Truck", weather="Storm", traffic="High"):
    return one(spark, Distance_km=d, Weight_tons=w, Vehicle_Type=v, Weather_Condition=weather, Traffic_Density=traffic)


def test_co2_by_hand(spark):
    got = shipment(spark).select(fx.co2_kg()).first()[0]
    assert got == pytest.approx((450 * 12 * 0.13 + 8.0) * 1.08 * 1.10)


def test_co2_floor_and_unknown(spark):
    assert shipment(spark, 0.0, 0.0, "Electric Semi", "Normal", "Low").select(fx.co2_kg()).first()[0] == 1.5
    assert shipment(spark, -50.0, 1.0, "Electric Semi", "Normal", "Low").select(fx.co2_kg()).first()[0] == 0.5
    assert shipment(spark, v="Hovercraft").select(fx.co2_kg(), fx.freight_cost()).first()[0] is None


def test_unknown_category_is_named(spark):
    with pytest.raises(UnknownCategoryError, match="Hovercraft"):
        fx.require_known_categories(shipment(spark, v="Hovercraft"))
    fx.require_known_categories(shipment(spark))


def test_full_grid_agrees_with_plain_arithmetic(spark):
    cells = list(itertools.product(P.VEHICLES, P.WEATHER, P.TRAFFIC, [1.0, 333.3], [0.5, 24.0]))
    df = spark.createDataFrame(cells, "Vehicle_Type string, Weather_Condition string, Traffic_Density string, Distance_km double, Weight_tons double")
    for row in df.select("*", fx.co2_kg().alias("kg"), fx.freight_cost().alias("cost")).collect():
        v = row["Vehicle_Type"]
        load = row["Distance_km"] * row["Weight_tons"]
        kg = (load * P.EMISSION_FACTOR[v] + P.BASE_EMISSION[v]) * P.WEATHER_CO2[row["Weather_Condition"]] * P.TRAFFIC_CO2[row["Traffic_Density"]]
        assert row["kg"] == pytest.approx(max(kg, 0.5), rel=1e-12)
        assert row["cost"] == pytest.approx(load * P.FREIGHT_RATE[v] + P.FREIGHT_FIXED[v], rel=1e-12)


@pytest.mark.parametrize("p,tier", [(0.0, P.LOW), (0.19, P.LOW), (0.1999999, P.LOW), (0.2, P.MEDIUM), (0.4999, P.MEDIUM),
                                    (0.5, P.HIGH), (1.0, P.HIGH), (math.nan, P.LOW)])
def test_tier_edges(spark, p, tier):
    assert one(spark, p=p).select(fx.risk_tier("p")).first()[0] == tier


def test_stored_value_is_tiered_after_rounding(spark):
    got = one(spark, p=0.4951).select(fx.risk_tier("p"), fx.risk_tier(fx.stored_probability("p"))).first()
    assert tuple(got) == (P.MEDIUM, P.HIGH)


def test_half_even_rounding(spark):
    got = one(spark, a=0.125, b=0.345, c=0.135).select(*[fx.stored_probability(c) for c in "abc"]).first()
    assert tuple(got) == (0.12, 0.34, 0.14)


def test_cost_threshold(spark):
    assert one(spark, r=4.0).select(fx.cost_threshold("r")).first()[0] == 0.2
    with pytest.raises(PySparkException):
        one(spark, r=0.0).select(fx.cost_threshold("r")).collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(1, 5000), st.floats(0.1, 60)), min_size=2, max_size=30))
def test_co2_grows_with_load(spark, pairs):
    df = spark.createDataFrame([(float(d), float(w)) for d, w in pairs], "Distance_km double, Weight_tons double")
    rows = df.select((F.col("Distance_km") * F.col("Weight_tons")).alias("x"), *[
        fx.co2_kg(vehicle=F.lit(v), weather=F.lit("Rain"), traffic=F.lit("Medium")).alias(v) for v in P.VEHICLES]).orderBy("x").collect()
    for a, b in zip(rows, rows[1:]):
        assert a["Diesel Truck"] <= b["Diesel Truck"] + 1e-6
    assert all(r["Electric Semi"] < r["Hybrid Van"] < r["Diesel Truck"] for r in rows)


def test_extrapolation_texts(spark):
    df = one(spark, Distance_km=50.0, Weight_tons=5.0, Vendor_Rating=4.95)
    texts = df.select(fx.extrapolation_warnings({"Distance_km": (100.0, 900.0), "Weight_tons": (1.0, 9.0), "Vendor_Rating": (1.0, 4.9)})).first()[0]
    assert len(texts) == 2 and "trained from 100" in texts[0] and "trained up to 4.9" in texts[1]


def test_route_key_keeps_nulls_apart(spark):
    rows = [("AB", "C", None), ("A", "BC", None), ("AB", None, "C"), (None, "AB", "C")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    assert df.select(route_key(["a", "b", "c"])).distinct().count() == 4


def test_calendar(spark):
    df = spark.sql("SELECT DATE '2026-12-06' AS d")
    assert tuple(df.select(date_id(F.col("d")), season(F.month("d"))).first()) == (20261206, "Winter")


def test_haversine_is_symmetric_and_zero_at_home(spark):
    df = one(spark, a=41.0, b=29.0, c=38.5, d=43.4)
    x, y, z = df.select(gen.haversine_km("a", "b", "c", "d"), gen.haversine_km("c", "d", "a", "b"), gen.haversine_km("a", "b", "a", "b")).first()
    assert x == pytest.approx(y) and z == 0 and 1200 < x < 1300


def test_poisson_days_follow_the_law(spark):
    n = 40000
    df = spark.range(n).select(gen.truncated_poisson_days(F.lit(1.2), (F.col("id") + 0.5) / n).alias("k"))
    got = {r["k"]: r["count"] / n for r in df.groupBy("k").count().collect()}
    weights = [1.2 ** k / math.factorial(k) for k in range(5)]
    for k in range(5):
        assert got[k + 1] == pytest.approx(weights[k] / sum(weights), abs=1e-4)


def test_vehicle_draws_repeat_and_match_their_probabilities(spark, view):
    df = view.select("Shipment_ID", gen.assign_vehicle().alias("v"), gen.vehicle_probabilities().alias("p"))
    assert df.select("Shipment_ID", "v").exceptAll(view.repartition(7).select("Shipment_ID", gen.assign_vehicle().alias("v"))).count() == 0
    share = df.agg(F.avg((F.col("v") == "Diesel Truck").cast("double")), F.avg(F.col("p")[0])).first()
    assert share[0] == pytest.approx(share[1], abs=0.02)
    assert df.where(F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).count() == 0

"""Dispatch probabilities by hand, and without an expression that is evaluated again for every element."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions import generators as gen
from cargolume.queries import REGISTRY
from cargolume.queries import verdict_queries as vq


def rows(spark):
    data = [("V1", 400.0, 3.0), ("V2", 1200.0, 24.0), ("V1", 60.0, 0.5), ("V3", None, 2.0), (None, 10.0, 1.0)]
    return spark.createDataFrame(data, "Vendor_ID string, Distance_km double, Weight_tons double")


def test_probabilities_are_the_softmax(spark):
    bias = [gen.normal(42, F.col("Vendor_ID"), F.lit(v)) * P.FLEET_BIAS_SD for v in P.VEHICLES]
    for r in rows(spark).select("*", gen.vehicle_probabilities().alias("p"), F.array(*bias).alias("bias")).collect():
        if r["Distance_km"] is None:
            assert r["p"] == [None] * 3
            continue
        d, w = (r["Distance_km"] - P.DISTANCE_CENTRE) / P.DISPATCH_DISTANCE_SCALE, (r["Weight_tons"] - P.DISPATCH_WEIGHT_CENTRE) / P.DISPATCH_WEIGHT_SCALE
        u = np.array([P.DISPATCH_BASE[v] + d * P.DISPATCH_DISTANCE[v] + w * P.DISPATCH_WEIGHT[v] for v in P.VEHICLES]) + r["bias"]
        assert r["p"] == pytest.approx(np.exp(u) / np.exp(u).sum())


def test_each_normal_is_drawn_once(spark):
    plan = rows(spark).select(gen.vehicle_probabilities().alias("p"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("cos(") == len(P.VEHICLES)  # 48 evaluations a row before


def test_verdict_stores_nothing(spark, folder, monkeypatch):
    monkeypatch.setattr(vq, "materialise", None)
    row = REGISTRY["assigned_vehicles_verdict"][0](spark, folder).first()
    assert row["shipments"] == row["ids"] == 6000 and row["vehicles"] == 3 and row["unknown"] == 0 and row["drawn_as_probable"]

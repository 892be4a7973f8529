"""What is shuffled, written and asked for: one narrow pass where there were several wide ones."""

import glob

import numpy as np
from pyspark.sql import functions as F

from cargolume.operators import allocation as al
from cargolume.operators import panels
from cargolume.session import fresh_path
from cargolume.sources import writers
from cargolume.sources.shipments import shipments


def folder_of(spark):
    """Tables of two suppliers, customers, parts and orders, with four lines."""
    path = fresh_path(spark, "tables")
    made = {
        "nation": ("n_nationkey int, n_name string", [(1, "A"), (2, "B")]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 1), (2, 2)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 2), (2, 1)]),
        "part": ("p_partkey long, p_type string", [(1, "LARGE"), (2, "ECONOMY")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderpriority string", [(1, 1, "1-URGENT"), (2, None, "3-MEDIUM"), (3, 2, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz",
                     [(1, 1, 1, 1, 10.0, None), (2, 2, 2, 1, 4.0, None), (3, 1, 1, 1, 2.0, None), (9, 2, 1, 1, 6.0, None)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_customers_are_joined_to_the_orders(spark):
    df = shipments(spark, folder_of(spark), ["Origin", "Destination", "Traffic_Density", "Vehicle_Type"])
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        ("A", "B", "High", "Diesel Truck"), ("B", None, "Medium", "Electric Semi"), ("A", "A", "Low", "Diesel Truck"), ("A", None, "Low", "Electric Semi")], key=str)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    sides = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    lines, customer = (next(x for x in sides if key in x) for key in ("l_orderkey", "c_custkey"))
    assert customer.index("Join") > lines.index("Join")  # below the join of the lines


def test_audit_log_is_compressed_and_reads_back(spark):
    row = dict(Shipment_ID="s", Vendor_ID="v", Distance_km=100.0, Weight_tons=2.0, Vendor_Rating=3.0, Weather_Condition="Rain", Traffic_Density="Low", Vehicle_Type="Hybrid Van", Delay_Risk_Probability=0.3)
    rows = writers.audit_rows(writers.assessments(spark.createDataFrame([row])))
    path = fresh_path(spark, "audit")
    assert writers.append_audit(rows, path)
    assert glob.glob(f"{path}/scored_on=*/*.json.gz") and not glob.glob(f"{path}/scored_on=*/*.json")
    assert spark.read.schema(rows.schema).json(path).select("shipment_id", "risk_level").first() == rows.select("shipment_id", "risk_level").first()


def test_pairs_are_dealt_by_shipment(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0)], "Shipment_ID string, x double").repartition("Shipment_ID")
    long = panels.counterfactual_grid(rows.select("Shipment_ID", "x", F.lit("").alias("Vehicle_Type")))
    risk = long.where("Vehicle_Type <> 'Hybrid Van'").select("Shipment_ID", "Vehicle_Type", (F.col("x") * 10).alias("p"))
    got = panels.align_risk(long, risk)
    assert got.columns == ["Shipment_ID", "x", "Vehicle_Type", "p"]
    assert got.where("Shipment_ID = 'a'").count() == 3 and got.where("Shipment_ID = 'b'").count() == 2 * 2 * 2 + 2
    assert got.where("p IS NULL").select("Vehicle_Type").distinct().collect() == [("Hybrid Van",)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = panels.align_risk(long, risk)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(Shipment_ID" in plan and "Vehicle_Type" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)


def test_longer_steps_are_asked_for_only_where_they_may_gain():
    rng = np.random.default_rng(3)
    cells = (np.full(200, 5.0), rng.uniform(1, 9, (200, 3)), rng.uniform(1, 9, (200, 3)))
    asked = []

    def fold(asks):
        asked.append(len(asks))
        return al._fold_cells(cells, asks)

    search = al._climb(al._Ask({}), 3, [300.0, 300.0, 400.0], 4500.0, 1000, 5.0, 4.0, 0.05, 500, None, 1e-8, False)
    theta, _, here, done = al._together([search], fold)[0]
    assert done and abs(here[2][0] - 4500.0) < 1e-3 and max(abs(here[2][1:] - [300.0, 300.0, 400.0])) < 1e-3
    assert asked.count(1) > len(asked) / 2 and sum(asked) < 2 * len(asked)

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cargolume.session import fresh_path
from cargolume.streaming import jobs as streams

SCHEMA = """Shipment_ID string, Vendor_ID string, Distance_km double, Weight_tons double, Vendor_Rating double,
  Weather_Condition string, Traffic_Density string, Vehicle_Type string, CO2_Emission_kg double, Actual_Delay_Days int,
  Risk_Level string, event_time timestamp"""
START = datetime(2026, 1, 1)


def row(i, day, weight=5.0, sid=None):
    return (sid or f"S{i}", "VEND-001", 100.0 + i, weight, 4.0, "Rain", "Low", "Hybrid Van", 50.0, i % 2,
            "High Risk" if i % 4 == 0 else "Low Risk", START + timedelta(days=day))


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def test_scoring_stream_is_once_per_shipment_and_resumes(spark):
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    def run():
        rows = streams.audit_stream(stream(spark, src), lambda d: d.withColumn("Delay_Risk_Probability", F.lit(0.3)))
        streams.run_audit(rows, out, out + "-state")
    feed(spark, src, [row(i, i) for i in range(6)] + [row(9, 1, sid="S1"), row(7, 2, weight=-1.0)])
    run()
    feed(spark, src, [row(i, i) for i in range(4, 8)])
    run()
    got = spark.read.parquet(out)
    assert got.count() == 8 and got.select("shipment_id").distinct().count() == 8
    assert len(got.columns) == 22 and {r[0] for r in got.select("risk_level").distinct().collect()} == {"Medium Risk"}


def test_late_decisions_are_kept(spark):
    """Three files, the later ones two months older; all rows stay, whether read at once or one by one."""
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    for first, day in ((0, 90), (2, 30), (4, 0)):
        feed(spark, src, [row(i, day) for i in (first, first + 1)] + [row(0, day)])
        rows = streams.audit_stream(stream(spark, src), lambda d: d.withColumn("Delay_Risk_Probability", F.lit(0.3)))
        streams.run_audit(rows, out, out + "-state")
    assert sorted(r["shipment_id"] for r in spark.read.parquet(out).collect()) == [f"S{i}" for i in range(6)]


def test_windows_close_on_the_watermark_and_drop_late_rows(spark):
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    def run():
        streams.run_to_end(streams.window_measures(stream(spark, src), width="10 days", delay="2 days"), out, out + "-state")
        return {r["window_start"]: r["shipments"] for r in spark.read.parquet(out).collect()}
    feed(spark, src, [row(i, i) for i in range(8)])
    before = run()
    feed(spark, src, [row(99, 60)])
    closed = run()
    assert len(closed) > len(before) and sum(closed.values()) == 8
    feed(spark, src, [row(50, 1), row(98, 61)])
    assert run() == closed, "a row behind the watermark changes nothing"


def test_stream_equals_its_batch_twin(spark):
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    feed(spark, src, [row(i, i) for i in range(40)] + [row(99, 400)])
    edges = [110.0, 120.0, 130.0]
    streams.run_to_end(streams.bin_counts(stream(spark, src), "Distance_km", edges, width="10 days", delay="1 day"), out, out + "-state")
    batch = streams.bin_counts(spark.read.schema(SCHEMA).parquet(src).where("Shipment_ID <> 'S99'"), "Distance_km", edges, width="10 days")
    got = spark.read.schema(batch.schema).parquet(out)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_drift_by_hand(spark):
    counts = spark.createDataFrame([(START, START, 0, 8), (START, START, 1, 2)], "window_start timestamp, window_end timestamp, bin int, n long")
    r = streams.drift(counts, [0.5, 0.5]).first()
    import math
    assert r["ks"] == pytest.approx(0.3) and r["psi"] == pytest.approx(0.3 * math.log(1.6) - 0.3 * math.log(0.4))
    same = streams.drift(counts, [0.8, 0.2]).first()
    assert same["psi"] == pytest.approx(0.0) and same["ks"] == pytest.approx(0.0)

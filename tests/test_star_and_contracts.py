import pytest
from pyspark.sql import functions as F

from cargolume.errors import IntegrityError, MissingColumnsError
from cargolume.operators import contracts as ct
from cargolume.operators import fingerprint as fp
from cargolume.operators import star
from cargolume.plans import jobs
from cargolume.schemas import FACT_COLUMNS, ROUTE_COLUMNS
from cargolume.session import fresh_path
from cargolume.sources import readers, writers


@pytest.fixture(scope="module")
def tables(tiny_raw):
    return jobs.build_star(tiny_raw)


def test_vendor_rating_is_the_mean(tables):
    got = {r[0]: r[1] for r in tables["dim_vendor"].collect()}
    assert got == {"VEND-001": 4.1, "VEND-002": 3.0, "VEND-003": 2.0}


def test_calendar_has_no_gaps(tables):
    assert [r["Date_ID"] for r in tables["dim_date"].orderBy("Date_ID").collect()] == [20260101, 20260102, 20260103, 20260104]


def test_fact_columns_and_keys(tables):
    assert tables["fact"].columns == FACT_COLUMNS and tables["fact"].count() == 6 and tables["dim_route"].count() == 2


def test_both_ways_to_the_route_key_agree(tiny_raw, tables):
    assert star.fact_by_lookup(tiny_raw, tables["dim_route"]).exceptAll(tables["fact"]).count() == 0


def test_missing_column_is_named(tiny_raw):
    with pytest.raises(MissingColumnsError, match="Vendor_Rating"):
        jobs.build_star(tiny_raw.drop("Vendor_Rating"))


def test_integrity_catches_each_fault(tables):
    f, v, r, d = (tables[k] for k in ("fact", "dim_vendor", "dim_route", "dim_date"))
    faults = {
        "dim_vendor.Vendor_ID unique": (f, v.union(v.limit(1)), r, d), "fact.Shipment_ID unique": (f.union(f.limit(1)), v, r, d),
        "fact.Vendor_ID resolves": (f, v.where("Vendor_ID <> 'VEND-002'"), r, d),
        "fact.Route_ID resolves": (f, v, r.limit(1), d), "dim_date contiguous": (f, v, r, d.where("Date_ID <> 20260103")),
        "fact.Route_ID not null": (f.withColumn("Route_ID", F.when(F.col("Shipment_ID") != "SHP-00001", F.col("Route_ID"))), v, r, d),
    }
    for check, args in faults.items():
        with pytest.raises(IntegrityError, match=check):
            ct.require_integrity(ct.star_integrity(*args))


def test_join_needs_unique_dimension_keys(tables):
    with pytest.raises(IntegrityError, match="dim_vendor"):
        star.analytical_dataset(tables["fact"], tables["dim_vendor"].union(tables["dim_vendor"]), tables["dim_route"], tables["dim_date"])


def test_route_keys_survive_new_rows(tiny_raw, tables):
    extra = tiny_raw.limit(1).withColumn("Origin", F.lit("Aaa"))
    grown = star.extend_routes(tables["dim_route"], tiny_raw.union(extra))
    assert grown.count() == 3 and tables["dim_route"].exceptAll(grown).count() == 0
    shuffled = star.dim_route(tiny_raw.orderBy(F.desc("Shipment_ID")))
    assert shuffled.exceptAll(tables["dim_route"]).count() == 0


def test_contract_accepts_good_and_reports_bad(tiny_raw):
    ct.require_clean(ct.contract_report(tiny_raw, "raw", ct.raw_rules(), "Shipment_ID"))
    bad = tiny_raw.withColumn("Vendor_Rating", F.lit(float("nan"))).withColumn("Weather_Condition", F.lit("Fog")).drop("Origin")
    bad = bad.union(bad.limit(1)).withColumn("Actual_Delay_Days", F.lit("soon"))
    got = {r["rule"]: r["violations"] for r in ct.contract_report(bad, "raw", ct.raw_rules(), "Shipment_ID").collect()}
    assert got["Vendor_Rating in range"] == 7 and got["Weather_Condition in set"] == 7 and got["Origin present"] == 1
    assert got["Shipment_ID unique"] == 1 and got["Actual_Delay_Days in range"] == 7 and got["Distance_km in range"] == 0


def test_physical_split(tiny_raw):
    odd = tiny_raw.withColumn("Weight_tons", F.when(F.col("Shipment_ID") == "SHP-00003", F.lit(None)).otherwise(F.col("Weight_tons") * 4))
    split = ct.physical_split(odd)
    assert {r["Shipment_ID"] for r in ct.quarantine(split).collect()} == {"SHP-00003", "SHP-00005"}
    assert ct.valid_rows(split).columns == odd.columns and ct.valid_rows(split).count() == 4


def test_distance_rule(tiny_raw):
    assert ct.require_distance_rule(tiny_raw).count() == 0
    broken = tiny_raw.withColumn("Distance_km", F.when(F.col("Shipment_ID") == "SHP-00001", 5000.0).otherwise(F.col("Distance_km")))
    with pytest.raises(IntegrityError, match="Ankara -> Izmir"):
        ct.require_distance_rule(broken)


def test_output_contract(tables):
    scored = tables["fact"].withColumn("Delay_Risk_Probability", F.lit(0.3)).withColumn("Risk_Level", F.lit("Medium Risk"))
    dims = (tables["dim_vendor"], tables["dim_route"], tables["dim_date"])
    ct.require_integrity(ct.output_integrity(scored, tables["fact"], *dims))
    with pytest.raises(IntegrityError, match="column order"):
        ct.require_integrity(ct.output_integrity(scored.select(*reversed(scored.columns)), tables["fact"], *dims))
    with pytest.raises(IntegrityError, match="row count"):
        ct.require_integrity(ct.output_integrity(scored.limit(5), tables["fact"], *dims))
    assert ct.tier_mismatches(scored).agg(F.sum("mismatches")).first()[0] == 0


def test_fingerprint_follows_content_only(spark, tables):
    a = fp.data_fingerprint(spark, tables)
    assert a["scored_table"] is None and a["source_tables"]
    again = {k: v.repartition(3) for k, v in tables.items()}
    assert fp.data_fingerprint(spark, again) == a
    changed = {**tables, "dim_vendor": tables["dim_vendor"].withColumn("Vendor_Rating", F.col("Vendor_Rating") + 0.01)}
    assert fp.data_fingerprint(spark, changed)["source_tables"] != a["source_tables"]
    rec, cur = fp.fingerprints(tables), fp.fingerprints({**changed, "dim_date": None})
    assert [r["table"] for r in fp.fingerprint_mismatches(rec, cur).collect()] == ["dim_vendor"]


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_star_roundtrip(spark, tables, format):
    path = fresh_path(spark, "star")
    writers.write_star(tables, path, format)
    back = readers.load_star(spark, path, format)
    for name, df in tables.items():
        assert back[name].exceptAll(df.select(*back[name].columns)).count() == 0 and back[name].count() == df.count()


def test_etl_job_from_csv(spark, tiny_raw):
    src = fresh_path(spark, "raw") + "_csv"
    writers.export_csv(tiny_raw.select(*reversed(tiny_raw.columns)).withColumn("extra", F.lit(1)), src, "Shipment_ID", files=2)
    out = jobs.run_etl(spark, src, fresh_path(spark, "etl"))
    assert out["fact"].count() == 6
    with pytest.raises(MissingColumnsError, match="Vehicle_Type"):
        short = fresh_path(spark, "raw") + "_csv"
        writers.export_csv(tiny_raw.drop("Vehicle_Type"), short, "Shipment_ID", files=1)
        readers.load_raw(spark, short)


def test_export_content_ignores_partitions(spark, tiny_raw):
    texts = []
    for n in (1, 5):
        path = fresh_path(spark, "x") + "_csv"
        writers.export_csv(tiny_raw.repartition(n), path, "Shipment_ID", files=1)
        texts.append([r["value"] for r in spark.read.text(path).collect()])
    assert texts[0] == texts[1]


def test_audit_failure_does_not_raise(spark, tiny_raw):
    scored = tiny_raw.withColumn("Delay_Risk_Probability", F.lit(0.6))
    rows = writers.audit_rows(writers.assessments(scored, {"Distance_km": (600.0, 700.0)}))
    assert len(rows.columns) == 22 and rows.where("extrapolated").count() == 4
    assert writers.append_audit(rows, fresh_path(spark, "audit")) is True
    assert writers.append_audit(rows, "nosuchscheme://nowhere/x") is False


def test_regrained_dimensions(tiny_raw):
    parts = star.regrained(tiny_raw)
    assert [parts[n].count() for n in ("lane", "vehicle", "condition", "fact")] == [2, 2, 2, 6]
    assert parts["fact"].join(parts["lane"], "lane_id").count() == 6
    assert ROUTE_COLUMNS[0] == "Origin"

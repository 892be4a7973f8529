import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cargolume.session import local_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4", "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return FOLDER


RAW_COLUMNS = ["Shipment_ID", "Shipment_Date", "Vendor_ID", "Vendor_Rating", "Origin", "Destination", "Distance_km",
               "Weight_tons", "Weather_Condition", "Traffic_Density", "Vehicle_Type", "Actual_Delay_Days", "CO2_Emission_kg"]


@pytest.fixture(scope="session")
def tiny_raw(spark):
    """Six shipments, three vendors (VEND-001 rated 4.0 and 4.2), two routes, 1 to 4 January 2026."""
    from cargolume.schemas import RAW

    rows = [
        ("SHP-00001", "2026-01-01", "VEND-001", 4.0, "Ankara", "Izmir", 500.0, 10.0, "Normal", "Low", "Diesel Truck", 0, 658.0),
        ("SHP-00002", "2026-01-01", "VEND-001", 4.2, "Ankara", "Izmir", 520.0, 8.0, "Normal", "Low", "Diesel Truck", 1, 549.0),
        ("SHP-00003", "2026-01-02", "VEND-002", 3.0, "Bursa", "Adana", 700.0, 5.0, "Snow", "High", "Hybrid Van", 3, 331.0),
        ("SHP-00004", "2026-01-02", "VEND-002", 3.0, "Bursa", "Adana", 710.0, 4.0, "Snow", "High", "Hybrid Van", 0, 270.0),
        ("SHP-00005", "2026-01-04", "VEND-003", 2.0, "Ankara", "Izmir", 510.0, 20.0, "Normal", "Low", "Diesel Truck", 2, 1334.0),
        ("SHP-00006", "2026-01-04", "VEND-003", 2.0, "Bursa", "Adana", 690.0, 1.0, "Snow", "High", "Hybrid Van", 0, 69.0),
    ]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="session")
def hot_day(spark):
    """900 rows on one day and 100 over ten others."""
    rows = [(f"S{i}", date(2026, 1, 5) if i < 900 else date(2026, 1, 1) + timedelta(days=i % 10), i % 2) for i in range(1000)]
    return spark.createDataFrame(rows, "Shipment_ID string, Full_Date date, is_delayed int").cache()


@pytest.fixture(scope="session")
def view(spark, folder):
    """The stored shipment view at the smallest scale."""
    from cargolume.session import materialise
    from cargolume.sources.shipments import shipments

    return materialise(shipments(spark, folder), "view")

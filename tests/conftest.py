from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faremill.schemas import BUSINESS_COLUMNS, RAW  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")

# One well-formed landed row; tests change single values of it.
FLIGHT = {
    "Airline": "Blue",
    "Date_of_Journey": "24/03/2019",
    "Source": "A",
    "Destination": "B",
    "Route": "A-B",
    "Dep_Time": "22:20",
    "Arrival_Time": "01:10 22 Mar",
    "Duration": "2h 50m",
    "Total_Stops": "non-stop",
    "Additional_Info": "No info",
    "Price": "3897",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("faremill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "lenient"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.fixture
def flights(spark):
    """Builds raw rows: one per given dict of deviations from the standard row."""

    def build(*changes: dict):
        rows = [tuple((FLIGHT | change)[name] for name in BUSINESS_COLUMNS) for change in changes]
        return spark.createDataFrame(rows, RAW)

    return build

"""Declared schemas of every layer. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(10, 2)
PERCENT = DecimalType(5, 2)
MEAN_STOPS = DecimalType(3, 2)

# Column names and order of the landed files.
BUSINESS_COLUMNS = [
    "Airline",
    "Date_of_Journey",
    "Source",
    "Destination",
    "Route",
    "Dep_Time",
    "Arrival_Time",
    "Duration",
    "Total_Stops",
    "Additional_Info",
    "Price",
]


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


RAW = _struct(**{name: StringType() for name in BUSINESS_COLUMNS})

# Converted files: the raw columns plus where each row came from, for a row whose number of
# fields is wrong its untouched text, and for a header line the order of its names.
MALFORMED = "malformed_record"
SOURCE_FILE = "source_file"
LAYOUT = "layout"
CONVERTED = StructType(
    RAW.fields
    + [
        StructField(MALFORMED, StringType(), True),
        StructField(SOURCE_FILE, StringType(), True),
        StructField(LAYOUT, LongType(), True),
    ]
)

# Columns and types of the declared bronze, silver and gold tables.
BRONZE_FLIGHTS = StructType(
    RAW.fields + [StructField("ingestion_timestamp", TimestampType(), True)]
)

SILVER_FLIGHTS = _struct(
    Airline=StringType(),
    Date_of_Journey=DateType(),
    Source=StringType(),
    Destination=StringType(),
    Route=StringType(),
    Dep_Time=StringType(),
    Arrival_Time=StringType(),
    Duration=StringType(),
    Total_Stops=IntegerType(),
    Additional_Info=StringType(),
    Price=MONEY,
    Duration_Minutes=IntegerType(),
    Is_Direct_Flight=BooleanType(),
    ingestion_timestamp=TimestampType(),
)

DIM_AIRLINES = _struct(
    airline=StringType(),
    total_flights=LongType(),
    avg_price=MONEY,
    most_common_route=StringType(),
    direct_flights_percentage=PERCENT,
    avg_stops=MEAN_STOPS,
    last_updated=TimestampType(),
)

DIM_ROUTES = _struct(
    route_id=StringType(),
    source=StringType(),
    destination=StringType(),
    total_flights=LongType(),
    avg_price=MONEY,
    min_price=MONEY,
    max_price=MONEY,
    median_price=MONEY,
    avg_stops=MEAN_STOPS,
    airlines_count=LongType(),
    last_updated=TimestampType(),
)

# One row per listed file and run, and one row per run. The file list of a run lives in
# the first table, so that no row grows with the number of files.
INGEST_FILES = _struct(
    run_id=StringType(),
    path=StringType(),
    target_name=StringType(),
    action=StringType(),
    status=StringType(),
    superseded=BooleanType(),
    message=StringType(),
    row_count=LongType(),
    malformed_rows=LongType(),
)

INGEST_RUNS = _struct(
    run_id=StringType(),
    run_ts=TimestampType(),
    files_processed=LongType(),
    files_uploaded=LongType(),
    errors=LongType(),
    malformed_rows=LongType(),
    verdict=StringType(),
)

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.plans import silver
from faremill.plans.bronze import bronze_flights
from faremill.schemas import BRONZE_FLIGHTS, SILVER_FLIGHTS


def test_p4_bronze_has_declared_columns_and_one_stamp(flights):
    bronze = bronze_flights(flights({}, {"Airline": "Red"}))
    assert bronze.columns == BRONZE_FLIGHTS.fieldNames()
    assert bronze.select("ingestion_timestamp").distinct().count() == 1


def test_a1_exact_copies_fold_and_nulls_are_equal(flights):
    rows = flights({}, {}, {"Route": None}, {"Route": None}, {"Price": "3897.00"})
    assert silver.distinct_flights(bronze_flights(rows)).count() == 3


def test_a1_ignores_the_stamp_of_an_appended_batch(flights):
    first = flights({}).withColumn("ingestion_timestamp", F.lit("2024-01-01").cast("timestamp"))
    second = flights({}).withColumn("ingestion_timestamp", F.lit("2024-01-02").cast("timestamp"))
    assert silver.distinct_flights(first.union(second)).count() == 1


def test_c2_schema_and_no_row_is_lost(flights, ansi):
    rows = flights({}, {"Price": "x"}, {"Date_of_Journey": "?"}, {"Airline": None})
    built = silver.silver_flights(bronze_flights(rows))
    assert [(f.name, f.dataType) for f in built.schema] == [
        (f.name, f.dataType) for f in SILVER_FLIGHTS
    ]
    assert built.count() == 4


def test_rejects_are_distinct_and_only_flagged_rows(flights, ansi):
    rows = flights({}, {"Price": "x"}, {"Price": "x"}, {"Total_Stops": "many"})
    found = silver.rejects(bronze_flights(rows)).select("rejected_columns").collect()
    assert sorted(r[0] for r in found) == ["Price", "Total_Stops"]

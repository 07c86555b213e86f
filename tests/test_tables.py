from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from faremill.plans import pipeline
from faremill.plans.bronze import bronze_flights
from faremill.schemas import DIM_AIRLINES
from faremill.sources import landing, tables
from faremill.sources.tables import Warehouse
from faremill.storage import children, file_count, path_exists, scratch_path, stored


@pytest.fixture
def warehouse(spark):
    house = Warehouse(scratch_path(spark, "wh"), prefix=f"t{os.urandom(4).hex()}_")
    tables.create_all(spark, house)
    return house


def is_external_at(spark, warehouse, table):
    place = tables.location_of(spark, warehouse.name(table))
    kind = spark.catalog.getTable(warehouse.name(table)).tableType
    return kind == "EXTERNAL" and place.rsplit("/", 1)[0].endswith(warehouse.location(table).split(":")[-1])


def versions(spark, warehouse, table):
    return [path for path, folder in children(spark, warehouse.location(table)) if folder]


@pytest.mark.parametrize("job", [tables.overwrite, tables.replace], ids=["overwrite", "replace"])
def test_a_failing_write_leaves_the_old_rows(spark, warehouse, flights, job):
    tables.overwrite(bronze_flights(flights({"Airline": "old"})), warehouse, "bronze.flights")
    before = versions(spark, warehouse, "bronze.flights")
    many = flights(*[{"Airline": f"n{i}"} for i in range(200)]).repartition(8, "Airline")
    broken = bronze_flights(many).withColumn(
        "Airline", F.when(F.col("Airline") == "n77", F.raise_error(F.lit("lost"))).otherwise(F.col("Airline"))
    )
    with pytest.raises(Exception, match="lost"):
        job(broken, warehouse, "bronze.flights")
    assert [r.Airline for r in tables.read_table(spark, warehouse, "bronze.flights").collect()] == ["old"]
    assert versions(spark, warehouse, "bronze.flights") == before


def test_readers_that_began_before_a_commit_finish(spark, warehouse, flights):
    for name in "ab":
        tables.overwrite(bronze_flights(flights({"Airline": name})), warehouse, "bronze.flights")
    reading = tables.read_table(spark, warehouse, "bronze.flights").select("Airline")
    begun = reading.toLocalIterator()
    tables.overwrite(bronze_flights(flights({"Airline": "c"})), warehouse, "bronze.flights")
    assert [r.Airline for r in begun] == ["b"]
    assert [r.Airline for r in tables.read_table(spark, warehouse, "bronze.flights").collect()] == ["c"]
    assert len(versions(spark, warehouse, "bronze.flights")) == 1 + tables.OLD_VERSIONS


def test_a_table_can_be_overwritten_from_itself(spark, warehouse, flights):
    tables.overwrite(bronze_flights(flights({}, {"Airline": "x"})), warehouse, "bronze.flights")
    own = tables.read_table(spark, warehouse, "bronze.flights")
    tables.overwrite(own.where("Airline = 'x'"), warehouse, "bronze.flights")
    assert [r.Airline for r in tables.read_table(spark, warehouse, "bronze.flights").collect()] == ["x"]


def test_versions_of_another_writer_are_left(spark, warehouse, flights):
    rows = bronze_flights(flights({}))
    slow = warehouse.new_version("bronze.flights")
    later = f"{warehouse.location('bronze.flights')}/{tables.VERSION}99999999999999999999-other"
    for place in (slow, later):
        rows.write.parquet(place)
    tables.overwrite(rows, warehouse, "bronze.flights")
    assert path_exists(spark, later)
    assert tables.read_table(spark, warehouse, "bronze.flights").count() == 1


def test_k9_declares_empty_external_tables(spark, warehouse):
    for table, schema in tables.TABLES.items():
        declared = tables.read_table(spark, warehouse, table)
        assert declared.count() == 0
        assert [(f.name, f.dataType) for f in declared.schema] == [(f.name, f.dataType) for f in schema]
        assert is_external_at(spark, warehouse, table)


def test_k9_again_empties_the_table(spark, warehouse, flights):
    tables.overwrite(bronze_flights(flights({})), warehouse, "bronze.flights")
    tables.create_all(spark, warehouse)
    assert tables.read_table(spark, warehouse, "bronze.flights").count() == 0


def test_k2_replaces_rows_and_keeps_schema_and_place(spark, warehouse, flights):
    for changes in ([{}, {"Airline": "x"}], [{"Airline": "y"}]):
        rows = bronze_flights(flights(*changes))
        shuffled = rows.select(*reversed(rows.columns))
        tables.overwrite(shuffled, warehouse, "bronze.flights")
    stored_rows = tables.read_table(spark, warehouse, "bronze.flights")
    assert [r.Airline for r in stored_rows.collect()] == ["y"]
    assert is_external_at(spark, warehouse, "bronze.flights")


def test_k2_refuses_an_unknown_column(spark, warehouse, flights):
    rows = bronze_flights(flights({})).withColumn("surprise", F.lit(1))
    with pytest.raises(ValueError, match="surprise"):
        tables.overwrite(rows, warehouse, "bronze.flights")


def test_k3_replaces_the_schema_and_stays_external(spark, warehouse):
    tables.replace(spark.range(3).withColumn("fresh", F.lit("x")), warehouse, "gold.dim_airlines")
    found = tables.read_table(spark, warehouse, "gold.dim_airlines")
    assert (found.columns, found.count()) == (["id", "fresh"], 3)
    assert is_external_at(spark, warehouse, "gold.dim_airlines")


def test_k10_rollback_removes_tables_and_folders_and_can_be_repeated(spark, warehouse, flights):
    tables.overwrite(bronze_flights(flights({})), warehouse, "bronze.flights")
    tables.replace(spark.range(3), warehouse, "gold.dim_routes")
    locations = pipeline.rollback(spark, warehouse)
    assert len(locations) == 4
    assert not any(path_exists(spark, place) for place in locations)
    assert not any(spark.catalog.tableExists(warehouse.name(table)) for table in tables.TABLES)
    assert pipeline.rollback(spark, warehouse) == []


def test_stored_frames_are_read_back_and_removed(spark):
    with stored(spark, spark.range(5), "x") as frame:
        assert frame.count() == 5
        place = frame.inputFiles()[0].rsplit("/", 1)[0]
    assert file_count(spark, place) == 0


def test_scratch_lies_in_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_whole_pipeline_twice_gives_the_same_gold(spark, warehouse, flights):
    changes = [{"Airline": a, "Source": s, "Price": p} for a in "XYZ" for s in "AB" for p in "123"]
    results = []
    for _ in range(2):
        root = scratch_path(spark, "raw")
        flights(*changes, *changes).write.options(**landing.CSV_FORMAT).csv(root)
        pipeline.run_all(spark, root, warehouse, exact=True)
        results.append(
            [
                sorted(map(tuple, tables.read_table(spark, warehouse, table).drop("last_updated").collect()))
                for table in ("gold.dim_airlines", "gold.dim_routes")
            ]
        )
    assert results[0] == results[1]
    airlines = tables.read_table(spark, warehouse, "gold.dim_airlines")
    assert [(f.name, f.dataType) for f in airlines.schema] == [(f.name, f.dataType) for f in DIM_AIRLINES]
    assert [tuple(r) for r in pipeline.airline_report(spark, warehouse).collect()] == [
        ("X", 6), ("Y", 6), ("Z", 6),
    ]
    assert {tuple(r) for r in pipeline.route_report(spark, warehouse).collect()} == {("A-B", 9), ("B-B", 9)}

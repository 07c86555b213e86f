"""What the physical plans must look like, whatever the size of the tables."""

from __future__ import annotations

import re

import pytest

from faremill.operators import cube, median
from faremill.plans import gold, silver
from faremill.schemas import BRONZE_FLIGHTS, CONVERTED, SILVER_FLIGHTS
from faremill.sources import landing
from faremill.sources.star import raw_flights
from faremill.storage import scratch_path


@pytest.fixture(scope="module")
def tables(spark):
    frames = {}
    for name, schema in {"bronze": BRONZE_FLIGHTS, "silver": SILVER_FLIGHTS}.items():
        path = scratch_path(spark, name)
        spark.createDataFrame([], schema).write.parquet(path)
        frames[name] = spark.read.schema(schema).parquet(path)
    return frames


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str) -> list[set[str]]:
    """Columns read by each scan."""
    return [set(re.findall(r"(\w+)#", part)) for part in re.findall(r"FileScan \w+ \[([^\]]*)\]", text)]


def test_silver_is_one_shuffle_without_the_stamp(tables):
    text = plan(silver.silver_flights(tables["bronze"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text
    (columns,) = read_columns(text)
    assert "ingestion_timestamp" not in columns and len(columns) == 11


def test_rejects_filter_before_the_shuffle(tables):
    text = plan(silver.rejects(tables["bronze"]))
    assert text.index("Exchange") < text.index("Filter")


def test_dim_airlines_reads_silver_once_and_joins_nothing(tables):
    text = plan(gold.dim_airlines(tables["silver"]))
    assert "Join" not in text and "Window" not in text
    assert read_columns(text) == [
        {"Airline", "Source", "Destination", "Total_Stops", "Price", "Is_Direct_Flight"}
    ]


def test_dim_routes_keeps_the_sketch_away_from_the_airlines(tables):
    text = plan(gold.dim_routes(tables["silver"]))
    assert sorted(map(sorted, read_columns(text))) == [
        ["Airline", "Destination", "Price", "Source", "Total_Stops"],
        ["Destination", "Price", "Source"],
    ]
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_exact_median_counts_before_it_shuffles(spark, tables):
    text = plan(median.price_counts(tables["silver"]))
    assert text.index("Exchange") < text.index("partial_count")
    assert read_columns(text) == [{"Source", "Destination", "Price"}]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        whole = plan(median.exact_medians(tables["silver"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in whole and "NestedLoop" not in whole
    # Prices leave an input task only as folded counts.
    assert whole.count("FileScan") == whole.count("partial_count(Price")


def test_common_route_keeps_one_candidate_per_task(tables):
    text = plan(cube.most_common_route(cube.route_counts(tables["silver"])))
    assert re.search(r"WindowGroupLimit .* 1, Partial", text)


def test_no_python_in_any_plan(tables):
    frames = [
        silver.silver_flights(tables["bronze"]),
        gold.dim_airlines(tables["silver"]),
        gold.dim_routes(tables["silver"], exact=True),
    ]
    assert not any("Python" in plan(f) or "Pandas" in plan(f) for f in frames)


def test_converted_scan_pushes_the_malformed_filter(spark):
    path = scratch_path(spark, "converted")
    spark.createDataFrame([], CONVERTED).write.parquet(path)
    assert "IsNull(malformed_record)" in plan(landing.read_converted(spark, path))


def test_conversion_joins_nothing_on_file_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    text = plan(landing.scan_files(spark, [str(tmp_path / "a.csv")]))
    assert "Join" not in text and "Exchange" not in text


def test_all_tables_are_joined_whatever_is_asked_for(spark):
    folder = "/root/testdata/sf0.001"
    assert len(read_columns(plan(raw_flights(spark, folder, ["Price"])))) == 9

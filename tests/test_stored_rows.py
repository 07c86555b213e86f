"""Queries that land one set of rows several times make it once: random values are the same in all their files."""

from __future__ import annotations

import pytest
from conftest import FLIGHT
from pyspark.sql import functions as F

from faremill import queries
from faremill.schemas import BUSINESS_COLUMNS
from faremill.sources import landing


@pytest.fixture
def random_rows(monkeypatch):
    def rows(spark, folder, columns=BUSINESS_COLUMNS, dirty=False):
        values = [F.lit(FLIGHT[name]).alias(name) for name in BUSINESS_COLUMNS]
        info = F.when(F.col("id") % 2 == 0, "A").otherwise("N").alias("Additional_Info")
        named = dict(zip(BUSINESS_COLUMNS, values)) | {"Airline": F.uuid().alias("Airline"), "Additional_Info": info}
        return spark.range(20).select(*[named[name] for name in columns])

    monkeypatch.setattr(queries, "raw_flights", rows)


def _airlines(spark, place):
    lines = landing.scan_files(spark, [place]).where("layout IS NULL AND malformed_record IS NULL")
    return {r.Airline for r in lines.select("Airline").collect()}


def test_f2_mixed_files(spark, random_rows):
    root = queries._mixed_files(spark, "")
    plain = _airlines(spark, f"{root}/plain-*.csv")
    backwards = landing.scan_files(spark, [f"{root}/swapped-*.csv"]).where("layout IS NULL")
    assert len(plain) == 20
    assert plain == {r.Price for r in backwards.collect()}
    assert _airlines(spark, f"{root}/old") < plain


def test_f5_consume(spark, random_rows, monkeypatch):
    rounds, land = [], queries.pipeline.land

    def watched(spark, root, warehouse):
        rounds.append(_airlines(spark, root))
        land(spark, root, warehouse)

    monkeypatch.setattr(queries.pipeline, "land", watched)
    assert [tuple(r) for r in queries.landing_consume(spark, "").collect()] == [(40, 0)]
    assert len(rounds[0]) == 20 and rounds[0] == rounds[1]


def test_f6_overlap(spark, random_rows):
    found = {}
    for row in queries.landing_overlap(spark, "").collect():
        found.setdefault(row.run, set()).add(row.Airline)
    assert len(found["one"]) == 20 and found["one"] == found["left"] and found["two"] < found["one"]


def test_f1_breaks(spark, random_rows):
    by_info = {}
    for row in queries.landing_breaks(spark, "").collect():
        by_info.setdefault(row.Additional_Info[-1], []).append(row.Airline)
    assert sorted(by_info["A"])[::2] == sorted(by_info["A"])[1::2] and len(set(by_info["A"] + by_info["N"])) == 20


def test_f6_lines_are_shuffled_for_the_orders_only(spark):
    plan = queries.raw_flights(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(l_partkey" not in plan

"""Edge values of every parsed column, under both ANSI settings."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from faremill.functions import numbers, parsing, paths
from faremill.plans.silver import typed_flights

DATES = {
    "24/03/2019": dt.date(2019, 3, 24),
    "1/5/2019": dt.date(2019, 5, 1),
    "01/5/2019": dt.date(2019, 5, 1),
    "2019-03-24": None,
    "31/2/2019": None,
    "": None,
    None: None,
}
DURATIONS = {
    "2h 50m": 170,
    "2h50m": 170,
    "19h": 1140,
    "50m": 50,
    "25h 5m": 1505,
    None: 0,
    "": 0,
    "abc": 0,
    "2 h 5 m": 0,
    "99999999999h": None,
    "99999999h": None,
    "1h 99999999999m": None,
    "1h 2h 3m 4m": 63,
}
STOPS = {
    "non-stop": 0,
    "1 stop": 1,
    "2 stops": 2,
    "3 stops": 3,
    "4 stops": 4,
    "5 stops": 0,
    "Non-stop": 0,
    None: 0,
}
PRICES = {
    "3897": Decimal("3897.00"),
    "  3897 ": Decimal("3897.00"),
    "3897.555": Decimal("3897.56"),
    "-0.005": Decimal("-0.01"),
    "abc": None,
    "123456789012": None,
    "": None,
    None: None,
}


def evaluate(spark, expression, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [row.v for row in rows.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "expression, cases",
    [
        (parsing.journey_date, DATES),
        (parsing.duration_minutes, DURATIONS),
        (parsing.stop_count, STOPS),
        (parsing.fare, PRICES),
    ],
    ids=["X1", "X2", "X6", "X4"],
)
def test_text_to_value(spark, ansi, expression, cases):
    assert evaluate(spark, expression, cases) == list(cases.values())


def test_p3_unknown_stops_count_as_direct(flights, ansi):
    rows = flights({"Total_Stops": "5 stops"}, {"Total_Stops": None}, {"Total_Stops": "1 stop"})
    found = {tuple(r) for r in typed_flights(rows).select("Total_Stops", "Is_Direct_Flight").collect()}
    assert found == {(0, True), (1, False)}


def test_p2_text_columns_stay(flights):
    row = typed_flights(flights({})).first()
    assert (row.Duration, row.Dep_Time, row.Arrival_Time) == ("2h 50m", "22:20", "01:10 22 Mar")


def test_rejected_columns(flights, ansi):
    cases = [
        ({}, ""),
        ({"Date_of_Journey": "2019-03-24"}, "Date_of_Journey"),
        ({"Duration": "abc"}, "Duration"),
        ({"Duration": "99999999999h"}, "Duration"),
        ({"Duration": None, "Price": "x"}, "Duration,Price"),
        ({"Total_Stops": "5 stops"}, "Total_Stops"),
        ({"Total_Stops": None, "Date_of_Journey": None}, "Date_of_Journey,Total_Stops"),
    ]
    for change, expected in cases:
        assert flights(change).select(parsing.rejected_columns()).first()[0] == expected


def test_x10_paths(spark):
    cases = {
        "/a/b.csv": ("csv", "b", "b.csv"),
        "/a/UP.CSV": ("csv", "UP", "UP.CSV"),
        "/a.d/x.tar.xlsx": ("xlsx", "x.tar", "x.tar.xlsx"),
        "/a.d/plain": ("", "plain", "plain"),
        "/a/.csv": ("", ".csv", ".csv"),
        "/a/name.": ("", "name.", "name."),
        "bare.zip": ("zip", "bare", "bare.zip"),
    }
    for part, expression in enumerate([paths.suffix, paths.stem, paths.base_name]):
        assert evaluate(spark, expression, cases) == [value[part] for value in cases.values()]


def test_p6_route_key_skips_null(spark):
    rows = spark.createDataFrame([("A", "B"), (None, "B"), (None, None)], "s string, d string")
    keys = [r[0] for r in rows.select(paths.route_key(F.col("s"), F.col("d"))).collect()]
    assert keys == ["A-B", "B", ""]


def test_mean_rounds_like_avg(spark, ansi):
    """Means from staged sums equal Spark's own, on sums that end near a rounding tie."""
    groups = [(g, Decimal(p) / 100) for g in range(1, 60) for p in range(7 * g, 7 * g + g * 3, 2)]
    rows = spark.createDataFrame(groups, "g int, p decimal(10,2)")
    staged = (
        rows.groupBy("g", (F.col("p") * 100 % 3).alias("part"))
        .agg(F.sum("p").alias("s"), F.count("p").alias("n"))
        .groupBy("g")
        .agg(numbers.mean_price(F.sum("s"), F.sum("n")).alias("m"))
    )
    direct = rows.groupBy("g").agg(F.avg("p").cast("decimal(10,2)").alias("m"))
    assert staged.exceptAll(direct).isEmpty() and direct.exceptAll(staged).isEmpty()


def test_means_of_nothing_are_null(spark, ansi):
    empty = spark.createDataFrame([(None, 0)], "s decimal(20,2), n bigint")
    row = empty.select(
        numbers.mean_price(F.col("s"), F.col("n")),
        numbers.mean_stops(F.col("s"), F.col("n")),
        numbers.percentage(F.col("n"), F.col("n")),
    ).first()
    assert tuple(row) == (None, None, None)

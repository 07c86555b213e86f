from __future__ import annotations

import math
from collections import defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill.operators import cube, median
from faremill.plans import gold, report
from faremill.plans.bronze import bronze_flights
from faremill.plans.silver import silver_flights
from faremill.schemas import DIM_AIRLINES, DIM_ROUTES


@pytest.fixture
def silver(flights):
    return lambda *changes: silver_flights(bronze_flights(flights(*changes)))


def by(df, key):
    return {row[key]: row for row in df.collect()}


def unique(*changes):
    """The same flights, kept apart by their info text."""
    return [change | {"Additional_Info": str(i)} for i, change in enumerate(changes)]


def test_c3_values(silver, ansi):
    rows = unique(
        {"Price": "100"},
        {"Price": "100.01", "Total_Stops": "1 stop"},
        {"Price": None, "Total_Stops": "2 stops", "Source": "C"},
    )
    built = gold.dim_airlines(silver(*rows))
    assert built.columns == DIM_AIRLINES.fieldNames()
    assert tuple(built.first())[:-1] == (
        "Blue", 3, Decimal("100.01"), "A-B", Decimal("33.33"), Decimal("1.00"),
    )


def test_c3_all_direct_airline(silver, ansi):
    assert gold.dim_airlines(silver({})).first().direct_flights_percentage == Decimal("100.00")


def test_w1_tie_goes_to_the_first_route(silver):
    rows = unique({"Source": "Z"}, {"Source": "M"}, {"Source": "M", "Destination": "A"})
    flights = silver(*rows)
    assert gold.dim_airlines(flights).first().most_common_route == "M-A"
    windowed = cube.most_common_route(cube.route_counts(flights))
    assert windowed.first().most_common_route == "M-A"


def test_w1_missing_source_sorts_first_in_both_forms(silver):
    flights = silver(*unique({"Source": None, "Destination": "X"}, {"Source": "A"}))
    assert gold.dim_airlines(flights).first().most_common_route == "X"
    assert cube.most_common_route(cube.route_counts(flights)).first().most_common_route == "X"


def test_j1_null_airline_keeps_metrics_without_route(silver):
    flights = silver(*unique({"Airline": None}, {"Airline": None}, {}))
    fused = by(gold.dim_airlines(flights), "airline")
    assert (fused[None].total_flights, fused[None].most_common_route) == (2, None)
    joined = by(
        cube.with_common_route(
            cube.airline_metrics(cube.route_cube(flights)),
            cube.most_common_route(cube.route_counts(flights)),
        ),
        "Airline",
    )
    assert (joined[None].total_flights, joined[None].most_common_route) == (2, None)
    assert joined["Blue"].most_common_route == fused["Blue"].most_common_route == "A-B"


def test_c4_values(silver, ansi):
    rows = unique(
        {"Price": "10"},
        {"Price": "20", "Airline": "Red"},
        {"Price": "30", "Airline": None},
        {"Price": "50.50", "Total_Stops": "3 stops"},
    )
    for exact in (False, True):
        built = gold.dim_routes(silver(*rows), exact=exact)
        assert built.columns == DIM_ROUTES.fieldNames()
        assert tuple(built.first())[:-1] == (
            "A-B", "A", "B", 4, Decimal("27.63"), Decimal("10.00"), Decimal("50.50"),
            Decimal("20.00"), Decimal("0.75"), 2,
        )


def test_c4_route_without_any_price(silver, ansi):
    flights = silver({"Price": None}, {"Source": None, "Price": "7"})
    for exact in (False, True):
        rows = by(gold.dim_routes(flights, exact=exact), "route_id")
        assert rows["A-B"].median_price is None and rows["A-B"].avg_price is None
        assert rows["B"].median_price == Decimal("7.00")


def test_p6_colliding_keys_stay_apart_in_c4_and_merge_in_c6(silver):
    flights = silver(
        {"Source": "A-B", "Destination": "C"}, {"Source": "A", "Destination": "B-C"}
    )
    routes = gold.dim_routes(flights)
    assert [r.route_id for r in routes.collect()] == ["A-B-C", "A-B-C"]
    merged = report.flights_by_route(routes).collect()
    assert [tuple(r) for r in merged] == [("A-B-C", 2)]


def test_t1_t2_orders(silver):
    flights = silver(
        *unique({"Airline": "R"}, {"Airline": "R"}, {"Airline": "Q", "Source": "K"}, {"Airline": "P"})
    )
    bars = report.flights_by_airline(gold.dim_airlines(flights)).collect()
    assert [tuple(r) for r in bars] == [("R", 2), ("P", 1), ("Q", 1)]
    ordered = gold.busiest_first(gold.dim_routes(flights)).collect()
    assert [r.route_id for r in ordered] == ["A-B", "K-B"]


def test_totals_agree(silver):
    changes = [{"Airline": a, "Source": s, "Price": p} for a in "XYZ" for s in "AB" for p in "123"]
    flights = silver(*changes)
    totals = [
        gold.dim_airlines(flights).agg(F.sum("total_flights")).first()[0],
        gold.dim_routes(flights).agg(F.sum("total_flights")).first()[0],
    ]
    assert totals == [18, 18]


PRICES = st.one_of(
    st.none(),
    st.integers(-(10**10) + 1, 10**10 - 1),
    st.integers(-100_100, 300_000),
    st.sampled_from([99_999, 100_000, 0, -1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), PRICES), min_size=1, max_size=60))
def test_a11_exact_median_is_the_middle_element(spark, fares):
    rows = [(s, "D", None if p is None else Decimal(p) / 100) for s, p in fares]
    silver = spark.createDataFrame(rows, "Source string, Destination string, Price decimal(10,2)")
    groups = defaultdict(list)
    for source, _, price in rows:
        if price is not None:
            groups[source].append(price)
    expected = {s: sorted(p)[math.ceil(len(p) / 2) - 1] for s, p in groups.items()}
    found = median.exact_medians(silver).collect()
    assert len(found) == len(expected)
    assert {r.Source: r.median_price for r in found} == expected


def test_a11_stored_counts_give_the_same_median(spark):
    silver = spark.range(5000).selectExpr(
        "concat('S', if(id % 3 = 0, 0, id % 7)) as Source",
        "'D' as Destination",
        "cast(id * 7919 % 100003 / 10.0 as decimal(10,2)) as Price",
    )
    prices = median.price_counts(silver).checkpoint()
    lazy, stored = median.exact_medians(silver), median.exact_medians(silver, prices)
    builtin = silver.groupBy("Source", "Destination").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY Price)").cast("decimal(10,2)").alias("m")
    )
    assert lazy.exceptAll(stored).isEmpty() and lazy.exceptAll(builtin).isEmpty()
    assert lazy.count() == builtin.count()

"""The two report queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL = "sum(total_flights)"


def flights_by_airline(dim_airlines: DataFrame) -> DataFrame:
    """Flights per airline, largest bar first."""
    totals = dim_airlines.groupBy("airline").agg(F.sum("total_flights").alias(TOTAL))
    return totals.orderBy(F.desc(TOTAL), "airline")


def flights_by_route(dim_routes: DataFrame) -> DataFrame:
    """Flights per route key. Routes that share a key are merged."""
    return dim_routes.groupBy("route_id").agg(F.sum("total_flights").alias(TOTAL))

"""Silver to the two gold dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.paths import route_key
from faremill.operators.cube import airline_profile, route_cube, route_price_stats
from faremill.operators.median import approx_medians, exact_medians
from faremill.schemas import DIM_AIRLINES, DIM_ROUTES


def dim_airlines(silver: DataFrame, cube: DataFrame | None = None) -> DataFrame:
    """C3. Pass a stored ``cube`` to share one pass over silver between both tables."""
    profile = airline_profile(route_cube(silver) if cube is None else cube)
    stamped = profile.withColumn("last_updated", F.current_timestamp())
    return stamped.select(*[F.col(name).alias(name) for name in DIM_AIRLINES.fieldNames()])


def dim_routes(
    silver: DataFrame,
    cube: DataFrame | None = None,
    exact: bool = False,
    prices: DataFrame | None = None,
) -> DataFrame:
    """C4, unordered. ``exact`` swaps the median sketch for the exact lower median, which
    takes stored ``prices`` (``price_counts``)."""
    stats = route_price_stats(route_cube(silver) if cube is None else cube)
    medians = exact_medians(silver, prices) if exact else approx_medians(silver)
    medians = medians.withColumnsRenamed({"Source": "s", "Destination": "d"})
    same_route = F.col("Source").eqNullSafe(F.col("s")) & F.col("Destination").eqNullSafe(F.col("d"))
    joined = stats.join(medians, same_route, "left").withColumns(
        {
            "route_id": route_key(F.col("Source"), F.col("Destination")),
            "last_updated": F.current_timestamp(),
        }
    )
    return joined.select(*[F.col(name).alias(name) for name in DIM_ROUTES.fieldNames()])


def route_totals(silver: DataFrame) -> DataFrame:
    """Flights per route, under its key."""
    flights = silver.groupBy("Source", "Destination").agg(F.count("*").alias("total_flights"))
    return flights.select(route_key(F.col("Source"), F.col("Destination")).alias("route_id"), "total_flights")


def busiest_first(routes: DataFrame) -> DataFrame:
    """Routes by volume, descending; ties by key, to make the order repeatable."""
    return routes.orderBy(F.desc("total_flights"), "route_id", "source", "destination")

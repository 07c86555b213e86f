"""The one pass over silver that both gold tables are rolled up from.

``route_cube`` keeps one row per (airline, source, destination) with partial sums. It is
a plain hash aggregate: a route that holds a third of all rows is folded to one row per
input task before the shuffle. Everything after it works on cube rows, whose number
follows the count of airlines and airports and not the count of flights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.functions.numbers import mean_price, mean_stops, percentage
from faremill.functions.paths import route_key

CUBE_KEYS = ["Airline", "Source", "Destination"]


def route_cube(silver: DataFrame) -> DataFrame:
    """A2-A5, A8, A9 at the finest grain."""
    return silver.groupBy(*CUBE_KEYS).agg(
        F.count("*").alias("flights"),
        F.count_if("Is_Direct_Flight").alias("direct_flights"),
        F.sum("Total_Stops").alias("stops"),
        F.count("Total_Stops").alias("stops_known"),
        F.sum("Price").alias("price_sum"),
        F.count("Price").alias("priced"),
        F.min("Price").alias("price_min"),
        F.max("Price").alias("price_max"),
    )


def _volume_metrics() -> list[Column]:
    return [
        F.sum("flights").alias("total_flights"),
        mean_price(F.sum("price_sum"), F.sum("priced")).alias("avg_price"),
        mean_stops(F.sum("stops"), F.sum("stops_known")).alias("avg_stops"),
    ]


def airline_metrics(cube: DataFrame) -> DataFrame:
    """One row per airline."""
    return cube.groupBy("Airline").agg(
        *_volume_metrics(),
        F.sum("direct_flights").alias("direct_flights"),
        percentage(F.sum("direct_flights"), F.sum("flights")).alias("direct_flights_percentage"),
    )


def airline_profile(cube: DataFrame) -> DataFrame:
    """``airline_metrics`` and the most common route in a single grouping.

    The least (-flights, source, destination) of an airline is its most flown route, ties
    going to the alphabetically first, so neither a window nor a join is needed. A NULL
    airline has no route, as it would find no partner in a join.
    """
    order = F.struct((-F.col("flights")).alias("rank"), "Source", "Destination")
    grouped = cube.groupBy("Airline").agg(
        *_volume_metrics(),
        percentage(F.sum("direct_flights"), F.sum("flights")).alias("direct_flights_percentage"),
        F.min(order).alias("top"),
    )
    return grouped.withColumn(
        "most_common_route",
        F.when(F.col("Airline").isNotNull(), route_key(F.col("top.Source"), F.col("top.Destination"))),
    ).drop("top")


def route_counts(silver: DataFrame) -> DataFrame:
    """Flights per airline and route."""
    counts = silver.groupBy(*CUBE_KEYS).count()
    return counts.withColumn("route", route_key(F.col("Source"), F.col("Destination")))


def most_common_route(counts: DataFrame) -> DataFrame:
    """First route of each airline by count; ties by source, then destination.

    The rank filter lets Spark keep one candidate per airline and task before the shuffle,
    so an airline with very many routes does not gather in one task.
    """
    busiest_first = Window.partitionBy("Airline").orderBy(
        F.desc("count"), F.asc_nulls_first("Source"), F.asc_nulls_first("Destination")
    )
    return (
        counts.withColumn("rank", F.row_number().over(busiest_first))
        .filter(F.col("rank") == 1)
        .select("Airline", F.col("route").alias("most_common_route"))
    )


def with_common_route(metrics: DataFrame, routes: DataFrame) -> DataFrame:
    """Left outer join on the airline; a NULL airline matches nothing and is kept."""
    return metrics.join(routes, "Airline", "left")


def route_price_stats(cube: DataFrame) -> DataFrame:
    """One row per route.

    Each cube row of a route is a different airline, so counting the named ones gives the
    distinct count without a second shuffle.
    """
    return cube.groupBy("Source", "Destination").agg(
        *_volume_metrics(),
        F.min("price_min").alias("min_price"),
        F.max("price_max").alias("max_price"),
        F.count("Airline").alias("airlines_count"),
    )

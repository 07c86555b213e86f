"""The median price of each route, approximate or exact.

The approximate form is one mergeable sketch per route. It is kept apart from the other
route metrics on purpose: together with the distinct airline count Spark would have to
shuffle a sketch for every (route, airline) pair instead of one for every route.

The exact form counts equal prices of a route first, within each input task, and shuffles only the
folded (route, price) rows. Bands of 1,000.00 then find the band that holds the middle rank,
and the prices of that band the middle itself. A DECIMAL(10,2) has at most 2 * 10^5 bands and
2 * 10^5 prices in a band (the one around zero), which bounds every window below however many rows a
route has.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.schemas import MONEY

ROUTE = ["Source", "Destination"]
BAND_WIDTH = 1000


def approx_medians(silver: DataFrame) -> DataFrame:
    """Lower median by ``percentile_approx`` at its default accuracy."""
    return silver.groupBy(*ROUTE).agg(
        F.percentile_approx("Price", 0.5).cast(MONEY).alias("median_price")
    )


def price_counts(silver: DataFrame) -> DataFrame:
    """Copies of every price of a route.

    Missing prices make a row of zero copies, which no rank can fall into. A filter would
    be pushed below the dedup that silver comes from, and that shuffle could no longer be
    shared with the other route metrics.
    """
    counted = silver.groupBy(*ROUTE, "Price").agg(F.count("Price").alias("copies"))
    return counted.withColumn("band", (F.col("Price").cast("int") / BAND_WIDTH).cast("int"))


def middle_bands(counts: DataFrame) -> DataFrame:
    """The band with the median of each route, and the rank wanted within that band."""
    copies = counts.groupBy(*ROUTE, "band").agg(F.sum("copies").alias("copies"))
    upwards = Window.partitionBy(*ROUTE).orderBy("band")
    whole = upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        copies.withColumn("target", F.ceil(F.sum("copies").over(whole) / 2))
        .withColumn("before", _running_before(upwards))
        .filter(_holds_target())
        .select(*ROUTE, "band", (F.col("target") - F.col("before")).alias("target"))
    )


def exact_medians(silver: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Element of rank ceil(n / 2) among the non-NULL prices of each route.

    ``counts`` may be ``price_counts`` already stored; else both uses share one shuffle of them.
    """
    counts = price_counts(silver) if counts is None else counts
    wanted = middle_bands(counts).toDF("s", "d", "b", "target")
    same_band = reduce(
        and_, [F.col(left).eqNullSafe(F.col(right)) for left, right in zip([*ROUTE, "band"], "sdb")]
    )
    upwards = Window.partitionBy(*ROUTE).orderBy("Price")
    return (
        counts.join(wanted, same_band)
        .withColumn("before", _running_before(upwards))
        .filter(_holds_target())
        .select(*ROUTE, F.col("Price").alias("median_price"))
    )


def _running_before(ordered: Window) -> Column:
    """Copies that sort before the current row."""
    frame = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("copies").over(frame) - F.col("copies")


def _holds_target() -> Column:
    return (F.col("before") < F.col("target")) & (
        F.col("target") <= F.col("before") + F.col("copies")
    )

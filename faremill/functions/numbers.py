"""Means and shares over partial sums, with the rounding of Spark's own ``avg``.

``avg`` of a DECIMAL(10,2) is a DECIMAL(14,6), so the mean is rounded at six digits and
again at two. A quotient with 20 digits keeps both roundings exact below 10^12 rows
per group, which lets the mean be taken from sums that were added up in stages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faremill.schemas import MEAN_STOPS, MONEY, PERCENT


def mean_price(total: Column, rows: Column) -> Column:
    """DECIMAL(10,2) mean of prices; NULL when no row has a price."""
    quotient = F.try_divide(total.cast("decimal(20,2)"), rows.cast("decimal(17,0)"))
    return quotient.cast("decimal(14,6)").cast(MONEY)


def mean_stops(total: Column, rows: Column) -> Column:
    """DECIMAL(3,2) mean of the stop counts."""
    return F.try_divide(total.cast("double"), rows.cast("double")).try_cast(MEAN_STOPS)


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, DECIMAL(5,2)."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return (ratio * 100).try_cast(PERCENT)

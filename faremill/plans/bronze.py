"""Converted files to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.schemas import BUSINESS_COLUMNS


def bronze_flights(converted: DataFrame) -> DataFrame:
    """The landed columns and one load stamp for the whole batch."""
    return converted.select(*BUSINESS_COLUMNS).withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )

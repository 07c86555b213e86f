"""Bronze to silver: whole-row dedup, then typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions import parsing
from faremill.schemas import BUSINESS_COLUMNS, SILVER_FLIGHTS


def business_columns(bronze: DataFrame) -> DataFrame:
    """The landed columns, without the load stamp."""
    return bronze.select(*BUSINESS_COLUMNS)


def distinct_flights(bronze: DataFrame) -> DataFrame:
    """A1: one row per distinct landed row.

    The stamp is dropped first, so it neither widens the shuffle nor keeps apart the same
    row landed twice. Copies fold within each input task before the shuffle, and hashing
    all the columns spreads the rest evenly.
    """
    return business_columns(bronze).dropDuplicates()


def typed_flights(flights: DataFrame) -> DataFrame:
    """The silver columns without the load stamp; keeps every row."""
    stops = parsing.stop_count(F.col("Total_Stops"))
    return flights.withColumns(
        {
            "Date_of_Journey": parsing.journey_date(F.col("Date_of_Journey")),
            "Total_Stops": stops,
            "Price": parsing.fare(F.col("Price")),
            "Duration_Minutes": parsing.duration_minutes(F.col("Duration")),
            "Is_Direct_Flight": parsing.is_direct(stops),
        }
    )


def silver_flights(bronze: DataFrame) -> DataFrame:
    """The silver table, with its load stamp."""
    typed = typed_flights(distinct_flights(bronze))
    return typed.withColumn("ingestion_timestamp", F.current_timestamp()).select(
        *SILVER_FLIGHTS.fieldNames()
    )


def rejects(bronze: DataFrame) -> DataFrame:
    """Distinct landed rows with a value that silver holds as NULL or as a default.

    Filtering comes before the dedup, so only the flagged rows are shuffled; the names of the columns, which follow
    from the row, are put together once for each row that is left.
    """
    flagged = business_columns(bronze).filter(parsing.is_rejected()).dropDuplicates()
    return flagged.withColumn("rejected_columns", parsing.rejected_columns())

"""Raw flight rows derived from a star schema of Parquet tables.

The rows have the shape of landed files: text only, with exact duplicates. All tables are always
joined, whatever columns are asked for, so that a row without a partner counts nowhere.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.schemas import BUSINESS_COLUMNS

# The columns used here, declared so that no file is opened while a query is built.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _places(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Nation key to region name; 25 rows at any scale."""
    nations = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.col("n_nationkey").alias(f"{prefix}_nation"), F.col("r_name").alias(f"{prefix}_region")
    )


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    """Every join but one is with a table as it is stored, whose size Spark knows: the size of a join it takes for the
    product of both sides, and would shuffle all lines for a small one.
    """
    orders = (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_places(spark, folder, "c"), F.col("c_nationkey") == F.col("c_nation"))
    )
    return (
        _table(spark, folder, "lineitem")
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_places(spark, folder, "s"), F.col("s_nationkey") == F.col("s_nation"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _clean_columns() -> dict[str, Column]:
    quantity = F.col("l_quantity").cast("int")
    line = F.col("l_linenumber")
    shipped = F.col("l_shipdate")
    hours = F.concat(quantity.cast("string"), F.lit("h"))
    return {
        "Airline": F.col("p_brand"),
        "Date_of_Journey": F.concat_ws(
            "/", *[part(shipped).cast("string") for part in (F.dayofmonth, F.month, F.year)]
        ),
        "Source": F.col("s_region"),
        "Destination": F.col("c_region"),
        "Route": F.concat_ws("-", F.col("s_region"), F.col("c_region")),
        "Dep_Time": F.lit("00:00"),
        "Arrival_Time": F.lit("00:00"),
        "Duration": F.when(quantity % 5 == 0, hours)
        .when(quantity % 7 == 0, F.concat(quantity.cast("string"), F.lit("m")))
        .otherwise(F.concat(hours, F.lit(" "), F.col("p_size").cast("string"), F.lit("m"))),
        "Total_Stops": F.when(line == 1, F.lit("non-stop"))
        .when(line == 2, F.lit("1 stop"))
        .when(line <= 6, F.concat((line - 1).cast("string"), F.lit(" stops"))),
        "Additional_Info": F.col("l_returnflag"),
        "Price": F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
    }


def _dirty_columns() -> dict[str, Column]:
    """The same rows with text that does not parse and with missing keys."""
    clean = _clean_columns()
    quantity = F.col("l_quantity").cast("int")
    line = F.col("l_linenumber")
    return clean | {
        "Airline": F.when(F.col("p_size") > 3, clean["Airline"]),
        "Date_of_Journey": F.when(quantity % 3 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .when(quantity % 11 == 0, F.lit("31/2/2019"))
        .otherwise(clean["Date_of_Journey"]),
        "Source": F.when(line != 6, clean["Source"]),
        "Duration": F.when(line == 1, F.lit("abc"))
        .when(line == 2, F.lit("99999999999h"))
        .when(line == 3, F.lit("2 h 5 m"))
        .when(line == 4, F.lit("99999999h 1m"))
        .when(line < 7, clean["Duration"]),
        "Total_Stops": F.when(quantity % 2 == 0, clean["Total_Stops"]).otherwise(F.lit("direct")),
        "Price": F.when(F.col("l_returnflag") == "A", F.lit("n/a"))
        .when(quantity == 7, F.lit("123456789012"))
        .otherwise(F.concat(F.lit("  "), clean["Price"], F.lit("55 "))),
    }


def raw_flights(
    spark: SparkSession,
    folder: str,
    columns: Iterable[str] = BUSINESS_COLUMNS,
    dirty: bool = False,
) -> DataFrame:
    """Raw rows with the asked-for columns; rows flagged ``R`` appear twice.

    The copies are made by one generator over the joined rows: a union would run the
    joins once per branch.
    """
    columns = list(columns)
    expressions = _dirty_columns() if dirty else _clean_columns()
    copies = F.array_repeat(F.lit(1), F.when(F.col("l_returnflag") == "R", F.lit(2)).otherwise(F.lit(1)))
    rows = _joined(spark, folder).select(
        *[expressions[name].alias(name) for name in columns], F.explode(copies).alias("copy")
    )
    return rows.select(*columns)

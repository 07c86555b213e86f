"""The named jobs C1 to C7 as plain functions, and all of them in order."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faremill.operators.cube import route_cube
from faremill.operators.median import price_counts
from faremill.operators.runs import first_errors, run_gate
from faremill.plans import gold, report, silver
from faremill.plans.bronze import bronze_flights
from faremill.schemas import INGEST_FILES
from faremill.sources import claims, landing, tables
from faremill.sources.tables import Warehouse
from faremill.storage import delete_path, file_count, path_exists, small_splits, stored

#: Bytes of Parquet that a task of the dedup reads at most; its map of whole rows takes some 15 to 20 times as much.
FOLD_BYTES = 32 << 20


class IngestFailed(RuntimeError):
    """The run gate refused a landing run; the message holds the first errors."""


def run_record(outcomes: DataFrame, *run: str) -> DataFrame:
    """K5: one row per run with its end time, counts and verdict.

    The file list itself stays one row per file in the outcomes table.
    """
    landed = (F.col("status") == "ok") & ~F.col("superseded")
    return run_gate(
        outcomes,
        *run,
        extra=[
            F.count_if(landed).alias("files_uploaded"),
            F.coalesce(F.sum("malformed_rows"), F.lit(0)).alias("malformed_rows"),
        ],
    ).withColumn("run_ts", F.current_timestamp())


def list_run(spark: SparkSession, root: str, warehouse: Warehouse, run_id: str) -> DataFrame:
    """Claims the landed files and writes the run's manifest, once.

    A repeated run id goes on from the manifest there is; until it is written, files that come are claimed too.
    """
    path = f"{warehouse.run_state(run_id)}/manifest"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        held = claims.claim(spark, root, run_id)
        with landing.stored_listing(spark, root, held) as listing:
            depth = F.max(F.size(F.split("held_path", "/")))
            seen = listing.agg(F.count("*").alias("files"), depth.alias("depth")).first()
            if file_count(spark, held) > seen.files:
                claims.return_hidden(spark, root, run_id, seen.depth or claims.LEVELS)
            landing.manifest(listing).write.mode("overwrite").parquet(path)
    files = spark.read.parquet(path)
    return files.withColumn(landing.MODIFIED, F.unix_millis("modificationTime"))


def convert_run(spark: SparkSession, files: DataFrame, warehouse: Warehouse, run_id: str) -> DataFrame:
    """Every batch of the run that is not committed yet, a few at a time; outcomes of all files.

    A batch is committed by its outcomes, which are written after its rows; a committed batch is never written again.
    """
    state = warehouse.run_state(run_id)
    batches = sorted(row.batch for row in files.select("batch").distinct().collect())

    def convert(batch: int) -> None:
        own = files.where(F.col("batch") == batch)
        chosen = own.where((F.col("action") == "csv") & ~F.col("superseded"))
        facts = landing.convert_batch(spark, chosen, f"{warehouse.converted}/run_id={run_id}/batch={batch}")
        outcomes = landing.file_outcomes(own, facts).withColumn("run_id", F.lit(run_id))
        outcomes.write.mode("overwrite").parquet(f"{state}/outcomes/batch={batch}")

    with ThreadPoolExecutor(landing.BATCHES_AT_ONCE) as pool:
        list(pool.map(convert, landing.remaining_batches(spark, state, batches)))
    schema = StructType([*INGEST_FILES.fields, *files.select("length", "modificationTime").schema.fields])
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{state}/outcomes")


def record_run(spark: SparkSession, outcomes: DataFrame, warehouse: Warehouse, run_id: str) -> None:
    """K5: the run's rows in both record tables, once per run id."""
    record = run_record(outcomes).withColumn("run_id", F.lit(run_id))
    for table, rows in (("ops.ingest_files", outcomes.select(*INGEST_FILES.fieldNames())), ("ops.ingest_runs", record)):
        if tables.read_table(spark, warehouse, table).where(F.col("run_id") == run_id).isEmpty():
            tables.append(rows, warehouse, table)


def land(spark: SparkSession, root: str, warehouse: Warehouse, run_id: str | None = None) -> str:
    """C1 up to the gate: landed files to Parquet, outcomes recorded, bad runs undone.

    The run first claims what has landed, so runs that overlap share no file. Every step leaves a committed mark under
    the run's own folder, so the same run id goes on where it was broken off, and is a no-op once done. Claimed files are
    deleted only after a successful verdict and returned after another. Returns the run id.
    """
    run_id = run_id or uuid.uuid4().hex
    files = list_run(spark, root, warehouse, run_id)
    outcomes = convert_run(spark, files, warehouse, run_id)
    record_run(spark, outcomes, warehouse, run_id)
    verdict = run_gate(outcomes).first()
    if verdict["verdict"] == "fail":
        delete_path(spark, f"{warehouse.converted}/run_id={run_id}")
        claims.give_back(spark, root, run_id)
        messages = [row["message"] for row in first_errors(outcomes).collect()]
        raise IngestFailed(
            f"{verdict['files_processed']} files processed, {verdict['errors']} errors: " + "; ".join(messages)
        )
    landing.consume(spark, root, run_id, outcomes, f"{warehouse.base}/quarantine/run_id={run_id}")
    return run_id


def build_bronze(spark: SparkSession, warehouse: Warehouse) -> None:
    """C1 from the converted files on: bronze is rebuilt whole."""
    converted = landing.read_converted(spark, warehouse.converted)
    tables.overwrite(bronze_flights(converted), warehouse, "bronze.flights")


def build_silver(spark: SparkSession, warehouse: Warehouse) -> None:
    """C2. Copies fold within each input task, whose rows lie side by side in a map, so a task's share is bounded."""
    bronze = tables.read_table(spark, warehouse, "bronze.flights")
    with small_splits(spark, FOLD_BYTES):
        tables.overwrite(silver.silver_flights(bronze), warehouse, "silver.flights")


def build_gold(spark: SparkSession, warehouse: Warehouse, exact: bool = False) -> None:
    """C3 and C4 over one stored cube: silver is read once for it, and apart for medians."""
    flights = tables.read_table(spark, warehouse, "silver.flights")
    with ExitStack() as folders:
        cube = folders.enter_context(stored(spark, route_cube(flights), "cube"))
        tables.replace(gold.dim_airlines(flights, cube), warehouse, "gold.dim_airlines")
        prices = None
        if exact:
            prices = folders.enter_context(stored(spark, price_counts(flights), "prices"))
        routes = gold.dim_routes(flights, cube, exact, prices)
        tables.replace(gold.busiest_first(routes), warehouse, "gold.dim_routes")


def airline_report(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """C5 over the stored table."""
    return report.flights_by_airline(tables.read_table(spark, warehouse, "gold.dim_airlines"))


def route_report(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """C6 over the stored table."""
    return report.flights_by_route(tables.read_table(spark, warehouse, "gold.dim_routes"))


def run_all(spark: SparkSession, root: str, warehouse: Warehouse, exact: bool = False) -> str:
    """C1 to C4 in order; each step starts only when the one before it has succeeded."""
    run_id = land(spark, root, warehouse)
    build_bronze(spark, warehouse)
    build_silver(spark, warehouse)
    build_gold(spark, warehouse, exact)
    return run_id


def rollback(spark: SparkSession, warehouse: Warehouse) -> list[str]:
    """C7."""
    return tables.rollback(spark, warehouse)

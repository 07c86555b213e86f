"""One runnable query per operator or job, over a folder of the supplied tables.

Load stamps are left out of the results, since no two runs share them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions import parsing
from faremill.functions.numbers import percentage
from faremill.operators import cube, median, runs
from faremill.plans import gold, pipeline, report, silver
from faremill.plans.bronze import bronze_flights
from faremill.schemas import INGEST_RUNS
from faremill.sources import landing, tables
from faremill.sources.star import raw_flights
from faremill.sources.tables import Warehouse
from faremill.storage import delete_path, file_count, in_parallel, move_file, path_exists, scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of one landed file with line breaks in fields, or of a compressed one; such a file is read in one task.
FILE_ROWS = 1_000_000
#: Landed text takes a seventh of its size this way; for the queries that land the raw rows several times at once.
PACKED = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS}


def _bronze(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    return bronze_flights(raw_flights(spark, folder, dirty=dirty))


def _silver(spark: SparkSession, folder: str, dirty: bool = False) -> DataFrame:
    return silver.silver_flights(_bronze(spark, folder, dirty))


def _of_silver(build: Callable[[DataFrame], DataFrame], dirty: bool = False) -> Query:
    """A query that derives silver from the tables and drops any load stamp at the end."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(_silver(spark, folder, dirty)).drop("ingestion_timestamp", "last_updated")

    return run


def _of_cube(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_silver(lambda flights: build(cube.route_cube(flights)))


def _of_text(column: str, parse: Callable[[Column], Column], names: str, dirty: bool = True) -> Query:
    """A raw text column beside its parsed form."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        text = F.col(column)
        return raw_flights(spark, folder, [column], dirty=dirty).select(text, parse(text)).toDF(*names.split())

    return run


def _new_warehouse(spark: SparkSession) -> Warehouse:
    """A scratch warehouse of its own for one query run."""
    warehouse = Warehouse(scratch_path(spark, "warehouse"), prefix=f"fm_{uuid.uuid4().hex}_")
    tables.create_all(spark, warehouse)
    return warehouse


def _kept(spark: SparkSession, result: DataFrame, *folders: str, warehouse: Warehouse | None = None) -> DataFrame:
    """The result in a folder of its own; the query's other folders, tables and schemas are removed."""
    path = scratch_path(spark, "result")
    result.write.parquet(path)
    if warehouse:
        tables.remove_all(spark, warehouse)
    for folder in folders:
        delete_path(spark, folder)
    return spark.read.schema(result.schema).parquet(path)


@contextmanager
def _stored_rows(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The raw rows, joined once for all the files that are made of them."""
    with stored(spark, raw_flights(spark, folder), "flights") as rows:
        yield rows


def _land_files(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> str:
    """The raw rows as CSV files in a new landing folder."""
    root = scratch_path(spark, "raw")
    rows = raw_flights(spark, folder) if rows is None else rows
    rows.write.options(**landing.CSV_FORMAT).csv(root)
    return root


def bronze_raw_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Text files in, Parquet out and back."""
    root, path = _land_files(spark, folder), scratch_path(spark, "converted")
    landing.write_converted(landing.scan_files(spark, [root], landing.LANDED_CSV), path)
    return _kept(spark, landing.read_converted(spark, path), root, path)


def bronze_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """One stamp for the whole batch."""
    return _bronze(spark, folder).agg(
        F.count("*").alias("flights"),
        F.count_distinct("ingestion_timestamp").cast("int").alias("stamps"),
    )


def silver_rejects(dirty: bool) -> Query:
    return lambda spark, folder: silver.rejects(_bronze(spark, folder, dirty))


def airline_route_join(flights: DataFrame) -> DataFrame:
    """J1 with both sides built apart; ``dim_airlines`` gives the same without a join."""
    metrics = cube.airline_metrics(cube.route_cube(flights)).drop("direct_flights")
    routes = cube.most_common_route(cube.route_counts(flights))
    return cube.with_common_route(metrics, routes).withColumnRenamed("Airline", "airline")


def _by_route(flights: DataFrame) -> DataFrame:
    """C6 from the columns that it needs; the medians of ``dim_routes`` are not."""
    return report.flights_by_route(gold.route_totals(flights))


def direct_share(grouped: DataFrame) -> DataFrame:
    """A8, A12."""
    direct, flights = F.sum("direct_flights"), F.sum("flights")
    return grouped.groupBy("Airline").agg(
        direct.alias("direct_flights"),
        percentage(direct, flights).alias("direct_flights_percentage"),
    )


def route_median_approx(flights: DataFrame) -> DataFrame:
    """A11 as shipped: is the rank of each approximate median within the sketch's bound?"""
    approx = median.approx_medians(flights).toDF("s", "d", "approx")
    same_route = F.col("Source").eqNullSafe(F.col("s")) & F.col("Destination").eqNullSafe(F.col("d"))
    ranks = (
        flights.join(approx, same_route)
        .groupBy("Source", "Destination")
        .agg(
            F.count("Price").alias("priced"),
            F.count_if(F.col("Price") < F.col("approx")).alias("below"),
            F.count_if(F.col("Price") <= F.col("approx")).alias("reached"),
        )
    )
    target = F.ceil(F.col("priced") / 2)
    slack = F.ceil(F.col("priced") / 10000)
    within = (F.col("below") < target + slack) & (F.col("reached") >= target - slack)
    return ranks.select("Source", "Destination", "priced", within.alias("within_bound"))


def _statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as the outcome of one landed file; a day is a run."""
    failed = F.col("event_type") == "error"
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.to_date("ts").alias("run_day"),
        F.when(failed, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        (F.col("value") >= 100).alias("superseded"),
        F.floor("value").alias("malformed_rows"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("path"),
        F.concat_ws(
            " ", F.floor("value").cast("string"), F.lit("in event"), F.col("event_id").cast("string")
        ).alias("message"),
    )


def ingest_gate(spark: SparkSession, folder: str) -> DataFrame:
    """K6 per day of events."""
    return runs.run_gate(_statuses(spark, folder), "run_day")


def ingest_first_errors(spark: SparkSession, folder: str) -> DataFrame:
    """T4."""
    return runs.first_errors(_statuses(spark, folder))


def ingest_runs(spark: SparkSession, folder: str) -> DataFrame:
    """K5: run records appended to their table and read back."""
    warehouse = _new_warehouse(spark)
    statuses = _statuses(spark, folder).withColumn("run_id", F.col("run_day").cast("string"))
    tables.append(pipeline.run_record(statuses, "run_id"), warehouse, "ops.ingest_runs")
    columns = [name for name in INGEST_RUNS.fieldNames() if name != "run_ts"]
    return _kept(spark, tables.read_table(spark, warehouse, "ops.ingest_runs").select(*columns), warehouse=warehouse)


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a file listing: folders by user, names by value, suffixes by type."""
    kind = F.col("event_type")
    ending = (
        F.when(kind == "view", F.lit(".csv"))
        .when(kind == "click", F.lit(".v2.CSV"))
        .when(kind == "purchase", F.lit(".xlsx"))
        .when(kind == "signup", F.lit(".Zip"))
        .otherwise(F.lit(""))
    )
    name = F.concat(F.floor("value").cast("string"), ending)
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.concat_ws("/", F.lit("/raw"), F.col("user_id").cast("string"), name).alias("path"),
        F.col("ts").alias("modificationTime"),
    )


def landing_routing(spark: SparkSession, folder: str) -> DataFrame:
    """S4, X10 over a listing."""
    return runs.route_files(_listing(spark, folder))


def landing_latest(spark: SparkSession, folder: str) -> DataFrame:
    """K4 over a listing, among the files that can be converted."""
    files = runs.route_files(_listing(spark, folder))
    return runs.latest_by_target(files.filter(F.col("action") == "csv"))


def _rename(spark: SparkSession, folder: str, name: Callable[[int], str]) -> None:
    """Moves the part files that a job wrote to names of our own."""
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    for i, row in enumerate(parts.orderBy("path").toLocalIterator()):
        move_file(spark, row.path, name(i))


def _mixed_files(spark: SparkSession, folder: str) -> str:
    """A landing folder with everything that can go wrong in one.

    All raw rows under the usual header and once more under a reversed one; older files of the same names; for every
    row a line with a field too many and a line with fields missing; a file without any known header; a sheet and an archive.
    All are compressed; CSV files say so by their names, and lie in folders that are named as the files would be if they were not.
    """
    root = scratch_path(spark, "raw")

    def write(frame: DataFrame, target: str, suffix: str = "csv", **options) -> None:
        """Part i becomes ``target``-i."""
        place = scratch_path(spark, "step")
        frame.write.options(**landing.CSV_FORMAT | PACKED | options).csv(place)

        def name(i: int) -> str:
            path = f"{root}/{target}-{i}.{suffix}"
            return f"{path}/{path.rsplit('/', 1)[-1]}.gz" if suffix == "csv" else path

        _rename(spark, place, name)
        delete_path(spark, place)

    with _stored_rows(spark, folder) as rows:
        write(rows.where("Additional_Info = 'A'"), "old/plain")
        write(rows.select(*reversed(rows.columns)), "swapped")
        broken = F.concat(F.col("Price"), F.lit(",more\nfew,fields"))
        write(rows.withColumn("Price", broken), "broken", quote="\u0000")
        write(rows.select("Price"), "unknown")
        write(rows.select("Price"), "sheet", "xlsx")
        write(rows.select("Price"), "archive", "zip")
        # Last, so that these win the names of the old ones; other old names are landed too.
        time.sleep(0.02)
        write(rows, "plain")
    return root


def landing_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """S4, K4, K11 over real files: outcomes per file, added up by action, status and superseded."""
    warehouse, root = _new_warehouse(spark), _mixed_files(spark, folder)
    run_id = pipeline.land(spark, root, warehouse)
    outcomes = tables.read_table(spark, warehouse, "ops.ingest_files").where(F.col("run_id") == run_id)
    kind = F.regexp_extract("target_name", "^[a-z]+", 0).alias("kind")
    result = outcomes.groupBy(kind, "action", "status", "superseded").agg(
        F.sum("row_count").alias("rows_landed"), F.sum("malformed_rows").alias("malformed_rows")
    )
    return _kept(spark, result, root, warehouse=warehouse)


def landing_consume(spark: SparkSession, folder: str) -> DataFrame:
    """K7: two rounds under the same file names; all rows of both arrive, no file stays."""
    warehouse, root = _new_warehouse(spark), scratch_path(spark, "raw")
    with _stored_rows(spark, folder) as rows:
        for _ in range(2):
            place = _land_files(spark, folder, rows)
            _rename(spark, place, lambda i: f"{root}/{i}.csv")
            delete_path(spark, place)
            pipeline.land(spark, root, warehouse)
    left = landing.list_files(spark, root).filter(F.col("action") == "csv").count()
    result = landing.read_converted(spark, warehouse.converted).agg(
        F.count("*").alias("rows_landed"), F.lit(left).alias("files_left")
    )
    return _kept(spark, result, root, warehouse=warehouse)


def landing_retry(spark: SparkSession, folder: str) -> DataFrame:
    """A run that broke off while it cleared, repeated; a file went away before it was converted."""
    warehouse, root = _new_warehouse(spark), _land_files(spark, folder)
    raw_flights(spark, folder).limit(3).coalesce(1).write.options(**landing.CSV_FORMAT).csv(f"{root}/lost")
    files = pipeline.list_run(spark, root, warehouse, "r1")
    lost = files.where("path LIKE '%/lost/%'").select("held_path")
    in_parallel(lambda path: delete_path(spark, path), (row.held_path for row in lost.toLocalIterator()))
    pipeline.record_run(spark, pipeline.convert_run(spark, files, warehouse, "r1"), warehouse, "r1")
    gone = files.where(F.pmod(F.xxhash64("path"), F.lit(2)) == 0).select("held_path")
    in_parallel(lambda path: delete_path(spark, path), (row.held_path for row in gone.toLocalIterator()))
    for _ in range(2):
        pipeline.land(spark, root, warehouse, run_id="r1")
    records = tables.read_table(spark, warehouse, "ops.ingest_runs").count()
    vanished = tables.read_table(spark, warehouse, "ops.ingest_files").where("status = 'vanished'").count()
    result = landing.read_converted(spark, warehouse.converted)
    result = result.withColumns({"records": F.lit(records), "vanished": F.lit(vanished)})
    return _kept(spark, result, root, warehouse=warehouse)


def landing_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs at once, each step of the one between two of the other; rows landed by each, files left."""
    warehouse, root = _new_warehouse(spark), scratch_path(spark, "raw")

    def drop_in(flights: DataFrame, name: str) -> None:
        flights.write.options(**landing.CSV_FORMAT | PACKED).csv(f"{root}/{name}")

    with _stored_rows(spark, folder) as rows:
        drop_in(rows, "first")
        one = pipeline.list_run(spark, root, warehouse, "one")
        drop_in(rows.where("Additional_Info = 'A'"), "second")
        two = pipeline.list_run(spark, root, warehouse, "two")
        for files, run_id in ((two, "two"), (one, "one")):
            pipeline.convert_run(spark, files, warehouse, run_id)
        drop_in(rows, "third")
    for run_id in ("one", "two"):
        pipeline.land(spark, root, warehouse, run_id=run_id)
    left = landing.scan_files(spark, [root], landing.LANDED_OR_PACKED)
    landed = {run: landing.read_converted(spark, f"{warehouse.converted}/run_id={run}") for run in ("one", "two")}
    landed["left"] = left.where(F.col(landing.LAYOUT).isNull()).select(*landed["one"].columns)
    counted = [frame.groupBy("Airline").agg(F.count("*").alias("flights")).withColumn("run", F.lit(run)) for run, frame in landed.items()]
    return _kept(spark, counted[0].union(counted[1]).union(counted[2]), root, warehouse=warehouse)


def landing_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Fields with line breaks in quotes arrive whole; lines of a wrong length in other files stay apart."""
    warehouse, root = _new_warehouse(spark), scratch_path(spark, "raw")
    with _stored_rows(spark, folder) as rows:
        broken = rows.withColumn("Additional_Info", F.concat(F.lit("first\n\"second\", "), F.col("Additional_Info")))
        broken.write.options(**landing.CSV_FORMAT | PACKED).csv(f"{root}/breaks")
        header = F.lit(",".join(rows.columns))
        lines = F.concat_ws("\n", header, F.to_csv(F.struct(*rows.columns)), F.lit('few,fie"lds'))
        rows.select(lines).write.options(**PACKED).text(f"{root}/short")
    _rename(spark, f"{root}/short", lambda i: f"{root}/short-{i}.csv.gz")
    pipeline.land(spark, root, warehouse)
    good = landing.read_converted(spark, warehouse.converted)
    bad = landing.malformed_rows(spark, warehouse.converted)
    counts = good.groupBy("Airline", "Additional_Info").agg(F.count("*").alias("flights"))
    lines = bad.groupBy(F.lit("malformed").alias("Airline"), F.col("malformed_record")).agg(F.count("*").alias("flights"))
    return _kept(spark, counts.union(lines), root, warehouse=warehouse)


def report_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Silver and gold through their stored tables."""
    warehouse = _new_warehouse(spark)
    tables.overwrite(_silver(spark, folder), warehouse, "silver.flights")
    pipeline.build_gold(spark, warehouse, exact=True)
    result = tables.read_table(spark, warehouse, "gold.dim_routes").drop("last_updated")
    return _kept(spark, result, warehouse=warehouse)


def _stored_report(report_of: Callable[[SparkSession, Warehouse], DataFrame]) -> Query:
    """C5, C6 over the stored gold tables."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        warehouse = _new_warehouse(spark)
        tables.overwrite(_silver(spark, folder), warehouse, "silver.flights")
        pipeline.build_gold(spark, warehouse)
        return _kept(spark, report_of(spark, warehouse), warehouse=warehouse)

    return run


def pipeline_report(spark: SparkSession, folder: str) -> DataFrame:
    """C1 to C4 from text files to the stored airline table."""
    warehouse, root = _new_warehouse(spark), _land_files(spark, folder)
    pipeline.run_all(spark, root, warehouse)
    result = tables.read_table(spark, warehouse, "gold.dim_airlines").drop("last_updated")
    return _kept(spark, result, root, warehouse=warehouse)


def rollback(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written before, tables and files left after."""
    warehouse = _new_warehouse(spark)
    tables.overwrite(_silver(spark, folder), warehouse, "silver.flights")
    written = tables.read_table(spark, warehouse, "silver.flights").count()
    locations = pipeline.rollback(spark, warehouse)
    left = sum(spark.catalog.tableExists(warehouse.name(table)) for table in tables.TABLES)
    files = sum(file_count(spark, place) for place in locations if path_exists(spark, place))
    tables.remove_all(spark, warehouse)
    return spark.range(1).select(
        F.lit(written).alias("rows_written"),
        F.lit(left).alias("tables_left"),
        F.lit(files).alias("files_left"),
    )


def queries() -> dict[str, Query]:
    return {
        "bronze_raw_scan": bronze_raw_scan,
        "bronze_stamp": bronze_stamp,
        "silver_dedup": lambda spark, folder: silver.distinct_flights(_bronze(spark, folder)),
        "silver_select": lambda spark, folder: silver.business_columns(_bronze(spark, folder)),
        "silver_dates": _of_text("Date_of_Journey", parsing.journey_date, "date_text journey_date"),
        "silver_duration": _of_text("Duration", parsing.duration_minutes, "duration_text minutes"),
        "silver_stops": _of_text("Total_Stops", parsing.stop_count, "stops_text stops"),
        "silver_direct": _of_text(
            "Total_Stops",
            lambda text: parsing.is_direct(parsing.stop_count(text)),
            "stops_text is_direct",
        ),
        "silver_price": _of_text("Price", parsing.fare, "price_text fare"),
        "silver_flights": _of_silver(lambda flights: flights),
        "silver_flights_dirty": _of_silver(lambda flights: flights, dirty=True),
        "silver_rejects": silver_rejects(dirty=False),
        "silver_rejects_dirty": silver_rejects(dirty=True),
        "airline_metrics": _of_cube(cube.airline_metrics),
        "direct_share": _of_cube(direct_share),
        "route_counts": _of_silver(cube.route_counts),
        "most_common_route": _of_silver(
            lambda flights: cube.most_common_route(cube.route_counts(flights))
        ),
        "airline_route_join": _of_silver(airline_route_join, dirty=True),
        "dim_airlines": _of_silver(gold.dim_airlines),
        "dim_airlines_dirty": _of_silver(gold.dim_airlines, dirty=True),
        "route_price_stats": _of_cube(
            lambda grouped: cube.route_price_stats(grouped).drop("avg_stops", "airlines_count")
        ),
        "route_median": _of_silver(median.exact_medians),
        "route_median_approx": _of_silver(route_median_approx),
        "route_airline_count": _of_silver(
            lambda flights: cube.route_price_stats(cube.route_cube(flights)).select(
                "Source", "Destination", "airlines_count"
            ),
            dirty=True,
        ),
        "dim_routes": _of_silver(lambda flights: gold.busiest_first(gold.dim_routes(flights, exact=True))),
        "dim_routes_dirty": _of_silver(
            lambda flights: gold.dim_routes(flights, exact=True), dirty=True
        ),
        "flights_by_airline": _of_silver(
            lambda flights: report.flights_by_airline(gold.dim_airlines(flights))
        ),
        "flights_by_route": _of_silver(_by_route),
        "flights_by_route_dirty": _of_silver(_by_route, dirty=True),
        "stored_flights_by_airline": _stored_report(pipeline.airline_report),
        "stored_flights_by_route": _stored_report(pipeline.route_report),
        "ingest_gate": ingest_gate,
        "ingest_first_errors": ingest_first_errors,
        "ingest_runs": ingest_runs,
        "landing_routing": landing_routing,
        "landing_latest": landing_latest,
        "landing_manifest": landing_manifest,
        "landing_consume": landing_consume,
        "landing_retry": landing_retry,
        "landing_overlap": landing_overlap,
        "landing_breaks": landing_breaks,
        "report_tables": report_tables,
        "pipeline_report": pipeline_report,
        "rollback": rollback,
    }

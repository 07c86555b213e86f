"""The registered queries once more, as SQL text for another engine to check against."""

from __future__ import annotations

from textwrap import dedent, indent

QUANTITY = "CAST(l_quantity AS INTEGER)"
DATE_TEXT = "day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate)"
DURATION = (
    f"CASE WHEN {QUANTITY} % 5 = 0 THEN {QUANTITY} || 'h' "
    f"WHEN {QUANTITY} % 7 = 0 THEN {QUANTITY} || 'm' "
    f"ELSE {QUANTITY} || 'h ' || p_size || 'm' END"
)
STOPS = (
    "CASE l_linenumber WHEN 1 THEN 'non-stop' WHEN 2 THEN '1 stop' WHEN 3 THEN '2 stops' "
    "WHEN 4 THEN '3 stops' WHEN 5 THEN '4 stops' WHEN 6 THEN '5 stops' END"
)
PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"

CLEAN = {
    "Airline": "p_brand",
    "Date_of_Journey": DATE_TEXT,
    "Source": "rs.r_name",
    "Destination": "rc.r_name",
    "Route": "rs.r_name || '-' || rc.r_name",
    "Dep_Time": "'00:00'",
    "Arrival_Time": "'00:00'",
    "Duration": DURATION,
    "Total_Stops": STOPS,
    "Additional_Info": "l_returnflag",
    "Price": PRICE,
}
DIRTY = CLEAN | {
    "Airline": "CASE WHEN p_size > 3 THEN p_brand END",
    "Date_of_Journey": (
        f"CASE WHEN {QUANTITY} % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') "
        f"WHEN {QUANTITY} % 11 = 0 THEN '31/2/2019' ELSE {DATE_TEXT} END"
    ),
    "Source": "CASE WHEN l_linenumber <> 6 THEN rs.r_name END",
    "Duration": (
        "CASE l_linenumber WHEN 1 THEN 'abc' WHEN 2 THEN '99999999999h' WHEN 3 THEN '2 h 5 m' "
        f"WHEN 4 THEN '99999999h 1m' WHEN 5 THEN {DURATION} WHEN 6 THEN {DURATION} END"
    ),
    "Total_Stops": f"CASE WHEN {QUANTITY} % 2 = 0 THEN {STOPS} ELSE 'direct' END",
    "Price": (
        "CASE WHEN l_returnflag = 'A' THEN 'n/a' "
        f"WHEN {QUANTITY} = 7 THEN '123456789012' ELSE '  ' || {PRICE} || '55 ' END"
    ),
}

PARSED_DATE = "CAST(try_strptime(Date_of_Journey, '%-d/%-m/%Y') AS DATE)"
PARSED_MINUTES = r"""TRY_CAST(
    CASE WHEN regexp_matches(Duration, '\d+h')
         THEN CAST(TRY_CAST(regexp_extract(Duration, '(\d+)h', 1) AS INTEGER) AS BIGINT) * 60 ELSE 0 END
  + CASE WHEN regexp_matches(Duration, '\d+m')
         THEN CAST(TRY_CAST(regexp_extract(Duration, '(\d+)m', 1) AS INTEGER) AS BIGINT) ELSE 0 END
  AS INTEGER)"""
PARSED_STOPS = (
    "CASE Total_Stops WHEN 'non-stop' THEN 0 WHEN '1 stop' THEN 1 WHEN '2 stops' THEN 2 "
    "WHEN '3 stops' THEN 3 WHEN '4 stops' THEN 4 ELSE 0 END"
)
PARSED_PRICE = "TRY_CAST(Price AS DECIMAL(10,2))"


def _with(query: str, **parts: str) -> str:
    """``query`` behind the named common table expressions, in order."""
    clauses = [f"{name} AS (\n{indent(dedent(text).strip(), '  ')}\n)" for name, text in parts.items()]
    return "WITH " + ",\n".join(clauses) + "\n" + dedent(query).strip()


def raw_sql(dirty: bool = False) -> str:
    columns = ",\n  ".join(f"{text} AS {name}" for name, text in (DIRTY if dirty else CLEAN).items())
    one_copy = dedent(
        """
        SELECT
          {columns}
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation nc ON c_nationkey = nc.n_nationkey
        JOIN region rc ON nc.n_regionkey = rc.r_regionkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ns ON s_nationkey = ns.n_nationkey
        JOIN region rs ON ns.n_regionkey = rs.r_regionkey
        """
    ).strip().format(columns=columns)
    return f"{one_copy}\nUNION ALL\n{one_copy}\nWHERE l_returnflag = 'R'"


SILVER = f"""
SELECT Airline, {PARSED_DATE} AS Date_of_Journey, Source, Destination, Route, Dep_Time, Arrival_Time,
  Duration, {PARSED_STOPS} AS Total_Stops, Additional_Info, {PARSED_PRICE} AS Price,
  {PARSED_MINUTES} AS Duration_Minutes, {PARSED_STOPS} = 0 AS Is_Direct_Flight
FROM (SELECT DISTINCT * FROM raw)
"""

ROUTE_KEY = "concat_ws('-', Source, Destination)"
# Half up at six digits and again at two, in whole numbers.
_MICROS = "((sum(CAST(Price * 100 AS BIGINT)) * 20000 + count(Price)) // (2 * count(Price)))"
MEAN_PRICE = f"CAST((({_MICROS} * 2 + 10000) // 20000) / 100.0 AS DECIMAL(10,2))"
# A double goes to a decimal by its shortest text, as on the other side.
MEAN_STOPS = (
    "CAST(CAST(CAST(sum(Total_Stops) AS DOUBLE) / count(Total_Stops) AS VARCHAR) AS DECIMAL(3,2))"
)
DIRECT = "count(*) FILTER (WHERE Is_Direct_Flight)"
SHARE = f"CAST(CAST({DIRECT} / CAST(count(*) AS DOUBLE) * 100 AS VARCHAR) AS DECIMAL(5,2))"
MEDIAN = "CAST(quantile_disc(Price, 0.5) AS DECIMAL(10,2))"

COUNTS = f"""
SELECT Airline, Source, Destination, {ROUTE_KEY} AS route, count(*) AS "count"
FROM silver GROUP BY Airline, Source, Destination
"""
COMMON = """
SELECT Airline, route AS most_common_route
FROM (SELECT *, row_number() OVER (PARTITION BY Airline
        ORDER BY "count" DESC, Source NULLS FIRST, Destination NULLS FIRST) AS place FROM counts)
WHERE place = 1
"""
METRICS = f"""
SELECT Airline, count(*) AS total_flights, {MEAN_PRICE} AS avg_price, {MEAN_STOPS} AS avg_stops,
  {DIRECT} AS direct_flights, {SHARE} AS direct_flights_percentage
FROM silver GROUP BY Airline
"""
AIRLINES = """
SELECT m.Airline AS airline, total_flights, avg_price, most_common_route,
  direct_flights_percentage, avg_stops
FROM metrics m LEFT JOIN common c ON m.Airline = c.Airline
"""
ROUTES = f"""
SELECT {ROUTE_KEY} AS route_id, Source AS source, Destination AS destination,
  count(*) AS total_flights, {MEAN_PRICE} AS avg_price, min(Price) AS min_price,
  max(Price) AS max_price, {MEDIAN} AS median_price, {MEAN_STOPS} AS avg_stops,
  count(DISTINCT Airline) AS airlines_count
FROM silver GROUP BY Source, Destination
"""

STATUS = """
SELECT CAST(ts AS DATE) AS run_day, event_type AS file,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
  event_id, value
FROM events
"""
VERDICT = (
    "CASE WHEN files_processed = 0 OR (errors > 0 AND errors >= files_processed) "
    "THEN 'fail' ELSE 'success' END"
)
LISTING = """
SELECT event_id, ts AS modificationTime,
  '/raw/' || user_id || '/' || CAST(floor(value) AS INTEGER) || CASE event_type
    WHEN 'view' THEN '.csv' WHEN 'click' THEN '.v2.CSV' WHEN 'purchase' THEN '.xlsx'
    WHEN 'signup' THEN '.Zip' ELSE '' END AS path
FROM events
"""
ROUTED = r"""
SELECT event_id, modificationTime, path, file_name, kind,
  CASE kind WHEN 'csv' THEN 'csv' WHEN 'xlsx' THEN 'excel' WHEN 'xls' THEN 'excel'
    WHEN 'zip' THEN 'skip_zip' ELSE 'ignored' END AS action,
  CASE WHEN kind IN ('xlsx', 'xls') THEN regexp_replace(file_name, '\.[^.]+$', '') || '.csv'
    ELSE file_name END AS target_name
FROM (SELECT *, lower(regexp_extract(file_name, '.\.([^.]+)$', 1)) AS kind
      FROM (SELECT *, regexp_extract(path, '[^/]*$') AS file_name FROM listing))
"""


def _silver(query: str, dirty: bool = False, **more: str) -> str:
    return _with(query, raw=raw_sql(dirty), silver=SILVER, **more)


def _rejects(dirty: bool) -> str:
    return _with(
        rf"""
        SELECT * FROM (
          SELECT *, concat_ws(',',
            CASE WHEN {PARSED_DATE} IS NULL THEN 'Date_of_Journey' END,
            CASE WHEN NOT coalesce(regexp_matches(Duration, '\d+[hm]'), FALSE)
              OR {PARSED_MINUTES} IS NULL THEN 'Duration' END,
            CASE WHEN NOT coalesce(Total_Stops IN ('non-stop', '1 stop', '2 stops', '3 stops', '4 stops'),
              FALSE) THEN 'Total_Stops' END,
            CASE WHEN {PARSED_PRICE} IS NULL THEN 'Price' END) AS rejected_columns
          FROM (SELECT DISTINCT * FROM raw))
        WHERE rejected_columns <> ''
        """,
        raw=raw_sql(dirty),
    )


def oracle_sql() -> dict[str, str]:
    raw, dirty = {"raw": raw_sql()}, {"raw": raw_sql(dirty=True)}
    airlines = {"counts": COUNTS, "common": COMMON, "metrics": METRICS}
    return {
        "bronze_raw_scan": _with("SELECT * FROM raw", **raw),
        "bronze_stamp": _with("SELECT count(*) AS flights, 1 AS stamps FROM raw", **raw),
        "silver_dedup": _with("SELECT DISTINCT * FROM raw", **raw),
        "silver_select": _with("SELECT * FROM raw", **raw),
        "silver_dates": _with(
            f"SELECT Date_of_Journey AS date_text, {PARSED_DATE} AS journey_date FROM raw", **dirty
        ),
        "silver_duration": _with(
            f"SELECT Duration AS duration_text, {PARSED_MINUTES} AS minutes FROM raw", **dirty
        ),
        "silver_stops": _with(
            f"SELECT Total_Stops AS stops_text, {PARSED_STOPS} AS stops FROM raw", **dirty
        ),
        "silver_direct": _with(
            f"SELECT Total_Stops AS stops_text, {PARSED_STOPS} = 0 AS is_direct FROM raw", **dirty
        ),
        "silver_price": _with(f"SELECT Price AS price_text, {PARSED_PRICE} AS fare FROM raw", **dirty),
        "silver_flights": _silver("SELECT * FROM silver"),
        "silver_flights_dirty": _silver("SELECT * FROM silver", dirty=True),
        "silver_rejects": _rejects(dirty=False),
        "silver_rejects_dirty": _rejects(dirty=True),
        "airline_metrics": _silver(METRICS),
        "direct_share": _silver(
            f"SELECT Airline, {DIRECT} AS direct_flights, {SHARE} AS direct_flights_percentage "
            "FROM silver GROUP BY Airline"
        ),
        "route_counts": _silver(COUNTS),
        "most_common_route": _silver(COMMON, counts=COUNTS),
        "airline_route_join": _silver(AIRLINES, dirty=True, **airlines),
        "dim_airlines": _silver(AIRLINES, **airlines),
        "dim_airlines_dirty": _silver(AIRLINES, dirty=True, **airlines),
        "route_price_stats": _silver(
            f"SELECT Source, Destination, count(*) AS total_flights, {MEAN_PRICE} AS avg_price, "
            "min(Price) AS min_price, max(Price) AS max_price FROM silver GROUP BY Source, Destination"
        ),
        "route_median": _silver(
            f"SELECT Source, Destination, {MEDIAN} AS median_price FROM silver "
            "WHERE Price IS NOT NULL GROUP BY Source, Destination"
        ),
        "route_median_approx": _silver(
            "SELECT Source, Destination, count(Price) AS priced, TRUE AS within_bound "
            "FROM silver GROUP BY Source, Destination"
        ),
        "route_airline_count": _silver(
            "SELECT Source, Destination, count(DISTINCT Airline) AS airlines_count "
            "FROM silver GROUP BY Source, Destination",
            dirty=True,
        ),
        "dim_routes": _silver(ROUTES),
        "dim_routes_dirty": _silver(ROUTES, dirty=True),
        "flights_by_airline": _silver(
            'SELECT Airline AS airline, count(*) AS "sum(total_flights)" FROM silver GROUP BY Airline'
        ),
        "flights_by_route": _silver(
            f'SELECT {ROUTE_KEY} AS route_id, count(*) AS "sum(total_flights)" FROM silver GROUP BY 1'
        ),
        "flights_by_route_dirty": _silver(
            f'SELECT {ROUTE_KEY} AS route_id, count(*) AS "sum(total_flights)" FROM silver GROUP BY 1',
            dirty=True,
        ),
        "stored_flights_by_airline": _silver(
            'SELECT Airline AS airline, count(*) AS "sum(total_flights)" FROM silver GROUP BY Airline'
        ),
        "stored_flights_by_route": _silver(
            f'SELECT {ROUTE_KEY} AS route_id, count(*) AS "sum(total_flights)" FROM silver GROUP BY 1'
        ),
        "ingest_gate": _with(
            f"SELECT *, {VERDICT} AS verdict FROM (SELECT run_day, "
            "count(*) FILTER (WHERE status = 'ok') AS files_processed, "
            "count(*) FILTER (WHERE status = 'error') AS errors FROM status GROUP BY run_day)",
            status=STATUS,
        ),
        "ingest_first_errors": _with(
            "SELECT 'event ' || event_id AS path, value || ' in event ' || event_id AS message "
            "FROM status WHERE status = 'error' ORDER BY 1 LIMIT 3",
            status="SELECT event_id, CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS value, "
            "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status FROM events",
        ),
        "ingest_runs": _with(
            f"SELECT *, {VERDICT} AS verdict FROM (SELECT CAST(run_day AS VARCHAR) AS run_id, "
            "count(*) FILTER (WHERE status = 'ok') AS files_processed, "
            "count(*) FILTER (WHERE status = 'ok' AND value < 100) AS files_uploaded, "
            "count(*) FILTER (WHERE status = 'error') AS errors, "
            "CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS malformed_rows "
            "FROM status GROUP BY run_day)",
            status=STATUS,
        ),
        "landing_routing": _with(
            "SELECT path, modificationTime, target_name, action FROM routed",
            listing=LISTING,
            routed=ROUTED,
        ),
        "landing_latest": _with(
            "SELECT target_name, modificationTime, path FROM (SELECT *, row_number() OVER "
            "(PARTITION BY target_name ORDER BY modificationTime DESC, path DESC) AS place "
            "FROM routed WHERE action = 'csv') WHERE place = 1",
            listing=LISTING,
            routed=ROUTED,
        ),
        "landing_manifest": _with(
            "SELECT kind, action, status, superseded, CAST(copies * n AS BIGINT) AS rows_landed, "
            "CAST(bad * n AS BIGINT) AS malformed_rows FROM (VALUES "
            "('archive', 'skip_zip', 'skipped', FALSE, 0, 0), ('sheet', 'excel', 'skipped', FALSE, 0, 0), "
            "('unknown', 'csv', 'error', FALSE, 0, 0), ('plain', 'csv', 'ok', TRUE, 0, 0), "
            "('plain', 'csv', 'ok', FALSE, 1, 0), ('swapped', 'csv', 'ok', FALSE, 1, 0), "
            "('broken', 'csv', 'error', FALSE, 2, 2)) AS f(kind, action, status, superseded, copies, bad), "
            "(SELECT count(*) AS n FROM raw)",
            **raw,
        ),
        "report_tables": _silver(ROUTES),
        "landing_consume": _with("SELECT 2 * count(*) AS rows_landed, 0 AS files_left FROM raw", **raw),
        "landing_retry": _with("SELECT *, 1 AS records, 1 AS vanished FROM raw", **raw),
        "landing_overlap": _with(
            "SELECT Airline, count(*) AS flights, run FROM raw, "
            "(VALUES ('one'), ('two'), ('left')) AS runs(run) "
            "WHERE run <> 'two' OR Additional_Info = 'A' GROUP BY Airline, run",
            **raw,
        ),
        "landing_breaks": _with(
            "SELECT Airline, 'first' || chr(10) || '\"second\", ' || Additional_Info AS Additional_Info, "
            "count(*) AS flights FROM raw GROUP BY ALL UNION ALL "
            "SELECT Airline, Additional_Info, count(*) FROM raw GROUP BY ALL UNION ALL "
            "SELECT 'malformed', 'few,fie\"lds', count(*) FROM raw",
            **raw,
        ),
        "pipeline_report": _silver(AIRLINES, **airlines),
        "rollback": _silver(
            "SELECT count(*) AS rows_written, 0 AS tables_left, 0 AS files_left FROM silver"
        ),
    }

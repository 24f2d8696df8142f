"""SQL that gives the same rows as the registered queries, for DuckDB."""

from delayworks.fixtures import FLIGHT_EXPRESSIONS, FLIGHT_ORDER
from delayworks.schema import FLIGHT_SCHEMA

# Fixed values, written out so that the SQL doesn't follow the code that it checks.
FLIGHT_KEY = ("FlightDate", "Marketing_Airline_Network", "OriginCityName", "DestCityName", "CRSDepTime")
CLEANED_MEASURES = (
    "DepDelay",
    "DepDelayMinutes",
    "TaxiOut",
    "TaxiIn",
    "ArrDelay",
    "ArrDelayMinutes",
    "CRSElapsedTime",
    "ActualElapsedTime",
    "AirTime",
    "Distance",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
)
DAILY_ROUTE_KEY = ("Year", "Month", "DayofMonth", "OriginCityName", "DestCityName")
MONTHLY_CARRIER_KEY = ("Year", "Month", "Marketing_Airline_Network")
ROUTE_CARRIER_KEY = ("OriginCityName", "DestCityName", "Marketing_Airline_Network")

RUN_DATE_SQL = "DATE '2024-03-15'"


def _quoted(names) -> str:
    return ", ".join(f'"{name}"' for name in names)


_RAW = tuple(FLIGHT_EXPRESSIONS)
_ORDER = ", ".join(FLIGHT_ORDER)
_KEY = _quoted(FLIGHT_KEY)
_COLUMNS = _quoted(_RAW)

# WITH clauses, each naming the frame of one step.
_FLIGHTS = f"""
WITH joined AS (
  SELECT l.*, o.o_orderpriority, orr.r_name AS origin_region, dr.r_name AS dest_region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region orr ON sn.n_regionkey = orr.r_regionkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region dr ON cn.n_regionkey = dr.r_regionkey
), flights AS (
  SELECT {", ".join(f'{sql} AS "{name}"' for name, sql in FLIGHT_EXPRESSIONS.items())}, {_ORDER}
  FROM joined
)"""

_UNIQUE = f"""{_FLIGHTS}, unique_flights AS (
  SELECT * EXCLUDE (copy_no) FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY {_ORDER}) AS copy_no FROM flights
  ) WHERE copy_no = 1
)"""


def _cleaned(name: str) -> str:
    return f'CASE WHEN COALESCE("{name}", 0) < 0 THEN 0 ELSE COALESCE("{name}", 0) END'


def _replaced(expression, names=CLEANED_MEASURES) -> str:
    """Raw columns in order, the named ones replaced by an expression."""
    return ", ".join(
        f'{expression(name)} AS "{name}"' if name in names else f'"{name}"' for name in _RAW
    )


_FLAG = 'CAST(CASE WHEN "ArrDelayMinutes" >= 15 THEN 1 ELSE 0 END AS INTEGER) AS is_delayed_15'

_SILVER = f"""{_UNIQUE}, cleaned AS (
  SELECT {_replaced(_cleaned)} FROM unique_flights
), silver AS (
  SELECT *, {_FLAG} FROM cleaned
)"""

_DAILY_MEASURES = """
  count(*) AS flights_count,
  avg("DepDelayMinutes") AS avg_dep_delay_minutes,
  count(*) FILTER (WHERE "ArrDelayMinutes" > 15) AS arr_delay_gt15_count,
  CAST(count(*) FILTER (WHERE "ArrDelayMinutes" > 15) * 100 AS DOUBLE) / count(*) AS arr_delay_gt15_pct,
  avg("TaxiOut") AS avg_taxi_out,
  avg("TaxiIn") AS avg_taxi_in"""

_LATE = 'count(*) FILTER (WHERE "DepDelayMinutes" > 0 OR "ArrDelayMinutes" > 0)'

_LATENESS = f"""
  count(*) AS total_flights,
  {_LATE} AS delay_flights,
  CAST({_LATE} * 100 AS DOUBLE) / count(*) AS delay_rate_pct"""

_DISTANCE = """
  sum("Distance") AS total_distance_miles,
  avg("Distance") AS avg_distance_miles"""


def _grouped(frame: str, keys, measures: str) -> str:
    return f"SELECT {_quoted(keys)}, {measures} FROM {frame} GROUP BY {_quoted(keys)}"


_MONTHLY = f"""{_LATENESS},
  avg("DepDelayMinutes") AS avg_departure_delay_min,
  avg("ArrDelayMinutes") AS avg_arrival_delay_min,{_DISTANCE}"""

_ROUTE = f"""{_LATENESS},
  avg("DepDelayMinutes" + "ArrDelayMinutes") AS avg_overall_delay_min,
  avg("AirTime") AS avg_air_time_min,{_DISTANCE}"""

_GOLD_DAILY = f'{_SILVER} {_grouped("silver", DAILY_ROUTE_KEY, _DAILY_MEASURES)}'
_GOLD_MONTHLY = f'{_SILVER} {_grouped("silver", MONTHLY_CARRIER_KEY, _MONTHLY)}'
_GOLD_ROUTE = f'{_SILVER} {_grouped("silver", ROUTE_CARRIER_KEY, _ROUTE)}'
_GOLD_DAILY_UNCLEANED = f'{_UNIQUE} {_grouped("unique_flights", DAILY_ROUTE_KEY, _DAILY_MEASURES)}'

_BRONZE = f"{_FLIGHTS} SELECT {RUN_DATE_SQL} AS ingestion_date, {_COLUMNS} FROM flights"
_BRONZE_STREAM = (
    f"{_FLIGHTS} SELECT {RUN_DATE_SQL} AS ingestion_date, {RUN_DATE_SQL} AS fecha, {_COLUMNS}"
    " FROM flights"
)
_ALL_FLIGHTS = f"{_FLIGHTS} SELECT {_COLUMNS} FROM flights"
_DISTINCT_KEYS = f"{_FLIGHTS} SELECT DISTINCT {_KEY} FROM flights"
_SILVER_ROWS = f"{_SILVER} SELECT * FROM silver"

# Values planted by checks.queries.damaged: departure clock, distance, one more column.
_BAD_CLOCK, _BAD_DISTANCE = "l_orderkey % 19 = 0", "l_orderkey % 23 = 0"


def _without_bad(name: str) -> str:
    bad = {"CRSDepTime": _BAD_CLOCK, "Distance": _BAD_DISTANCE}[name]
    return f'CASE WHEN {bad} THEN NULL ELSE "{name}" END'


_DAMAGED = f"""{_FLIGHTS}, damaged AS (
  SELECT {_replaced(_without_bad, ("CRSDepTime", "Distance"))},
    CASE WHEN {_BAD_CLOCK} THEN '"CRSDepTime":"x"' END AS clock_json,
    CASE WHEN {_BAD_DISTANCE} THEN '"Distance":"far"' END AS distance_json,
    CASE WHEN l_partkey % 3 <> 0 THEN NULL WHEN l_partkey % 2 = 0 THEN '"surprise":"even"'
      ELSE '"surprise":"odd"' END AS surprise_json
  FROM flights
)"""

_RESCUED = f"""{_DAMAGED} SELECT {{stamps}}{_COLUMNS},
  '{{{{' || NULLIF(concat_ws(',', clock_json, distance_json, surprise_json), '') || '}}}}' AS _rescued_data
  FROM damaged"""

_BROKEN = f"""{_FLIGHTS} SELECT {{stamps}}
  {", ".join(f'CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE "{c}" END AS "{c}"' for c in _RAW)},
  CASE WHEN l_orderkey % 29 = 0
    THEN '{{{{"_corrupt_record":"{{{{broken ' || concat_ws(' ', {_ORDER}) || '"}}}}' END AS _rescued_data
  FROM flights"""

_DECLARED = f"CAST(NULL AS DATE) AS {FLIGHT_SCHEMA.names[0]}, "

_BOTH_FORMS = f"""{_UNIQUE}, daily AS (
    {_grouped("unique_flights", DAILY_ROUTE_KEY, _DAILY_MEASURES)}
  ) SELECT *, unnest(['append', 'update']) AS form FROM daily"""
_FINISHED_DAYS = f"""{_UNIQUE} {_grouped("unique_flights", DAILY_ROUTE_KEY, _DAILY_MEASURES)}
  HAVING min("FlightDate") + INTERVAL 1 DAY
    <= (SELECT max("FlightDate") FROM flights) - INTERVAL 1 DAY"""

ORACLE_SQL = {
    "stamp_ingestion": _BRONZE,
    "stamp_arrival_time": f"""{_FLIGHTS}
  SELECT count(*) AS row_count, count(*) AS stamped, 'timestamp' AS stamp_type, true AS one_per_batch FROM flights""",
    "stamp_today": f"""{_FLIGHTS}
  SELECT count(*) AS row_count, 1::BIGINT AS days, 'date' AS stamp_type, true AS is_today FROM flights""",
    "ignore_missing_files": f"{_FLIGHTS} SELECT {_COLUMNS} FROM flights WHERE l_linenumber > 1",
    "conform": _ALL_FLIGHTS,
    "conform_null_on_error": f"{_DAMAGED} SELECT {_COLUMNS} FROM damaged",
    "fill_nulls": f"""{_FLIGHTS} SELECT {_replaced(lambda c: f'COALESCE("{c}", 0)')} FROM flights""",
    "clamp_min": f"""{_FLIGHTS} SELECT {_replaced(
        lambda c: f'CASE WHEN "{c}" < 0 THEN 0 ELSE "{c}" END')} FROM flights""",
    "delay_flag": f"{_FLIGHTS} SELECT {_COLUMNS}, {_FLAG} FROM flights",
    "rescue_columns": _RESCUED.format(stamps=_DECLARED),
    "scalar_expressions": f"""{_FLIGHTS} SELECT {_KEY}, {_ORDER},
  "ArrDelayMinutes" > 15 AS beyond_15,
  "ArrDelayMinutes" >= 15 AS reaches_15,
  "DepDelay" < 0 AS early,
  "DepDelayMinutes" > 0 OR "ArrDelayMinutes" > 0 AS late,
  CAST(CASE WHEN "DepDelayMinutes" > 0 OR "ArrDelayMinutes" > 0 THEN 1 ELSE 0 END AS INTEGER) AS late_flag,
  "DepDelayMinutes" + "ArrDelayMinutes" AS overall_delay,
  CAST("CRSDepTime" * 100 AS DOUBLE) / NULLIF("CRSArrTime", 0) AS clock_pct,
  CAST("Distance" AS BIGINT) AS distance_whole
  FROM flights""",
    "aggregate_functions": f"""{_FLIGHTS} SELECT "Marketing_Airline_Network",
  count(*) AS row_count,
  avg("ArrDelay") AS avg_column,
  avg("DepDelay" + "ArrDelay") AS avg_expression,
  sum("AirTime") AS sum_column,
  {_LATE} AS conditional_count,
  CAST({_LATE} * 100 AS DOUBLE) / count(*) AS ratio_pct
  FROM flights GROUP BY "Marketing_Airline_Network\"""",
    "dedup": f"{_UNIQUE} SELECT {_COLUMNS} FROM unique_flights",
    "dedup_any_row": _DISTINCT_KEYS,
    "silver_transform": _SILVER_ROWS,
    "gold_daily_route": _GOLD_DAILY,
    "gold_monthly_carrier": _GOLD_MONTHLY,
    "gold_route_performance": _GOLD_ROUTE,
    "profile_counts": f"""{_SILVER}
  SELECT 'before' AS stage, count(*) AS rows FROM flights
  UNION ALL SELECT 'after' AS stage, count(*) AS rows FROM silver""",
    "dated_path_roundtrip": _ALL_FLIGHTS,
    "partitioned_roundtrip": _GOLD_DAILY,
    "partition_value_kept": f"""{_FLIGHTS}
  SELECT lpad(("CRSDepTime" // 60)::VARCHAR, 3, '0') AS hour_code, count(*) AS flights FROM flights GROUP BY 1""",
    "bronze_batch": _BRONZE,
    "silver_batch": (
        f"{_SILVER} SELECT {RUN_DATE_SQL} AS ingestion_date, silver.* FROM silver"
    ),
    "gold_batch_daily_route": _GOLD_DAILY,
    "gold_batch_monthly_carrier": _GOLD_MONTHLY,
    "gold_batch_route_performance": _GOLD_ROUTE,
    "rerun_of_one_date": f"""{_FLIGHTS} SELECT {_replaced(
        lambda c: f'CASE WHEN l_linenumber % 3 = 1 THEN "{c}" + 1 ELSE "{c}" END', ("Distance",))},
  CAST({RUN_DATE_SQL} + CAST(l_linenumber % 3 AS INTEGER) AS DATE) AS ingestion_date FROM flights""",
    "versioned_layers": _GOLD_DAILY,
    "bronze_batch_broken_lines": _BROKEN.format(stamps=f"{RUN_DATE_SQL} AS ingestion_date, "),
    "bronze_stream_broken_lines": _BROKEN.format(stamps=f"{RUN_DATE_SQL} AS ingestion_date, {RUN_DATE_SQL} AS fecha, "),
    "bronze_stream_broken_lines_by_file": _BROKEN.format(
        stamps=f"{RUN_DATE_SQL} AS ingestion_date, {RUN_DATE_SQL} AS fecha, "
    ),
    "bronze_stream": _BRONZE_STREAM,
    "bronze_stream_backfill": _BRONZE_STREAM,
    "bronze_stream_archived": _BRONZE_STREAM,
    "bronze_stream_drift": f"""{_FLIGHTS} SELECT {RUN_DATE_SQL} AS ingestion_date, {RUN_DATE_SQL} AS fecha,
  {_replaced(lambda c: f'CASE WHEN l_linenumber % 3 = 2 AND {_BAD_DISTANCE} THEN NULL ELSE "{c}" END', ("Distance",))},
  CASE WHEN l_linenumber % 3 = 1 THEN '{{"surprise":"more"}}'
    WHEN l_linenumber % 3 = 2 AND {_BAD_DISTANCE} THEN '{{"Distance":"far"}}' END AS _rescued_data
  FROM flights""",
    "bronze_stream_rescued": _RESCUED.format(
        stamps=f"{RUN_DATE_SQL} AS ingestion_date, {RUN_DATE_SQL} AS fecha, "
    ),
    "silver_stream": _DISTINCT_KEYS,
    "silver_stream_bounded": _DISTINCT_KEYS,
    "silver_stream_stored": _DISTINCT_KEYS,
    "stream_counts": f"""{_FLIGHTS}, sizes AS (
    SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM flights)) AS keys FROM flights
  ) SELECT unnest(['bronze', 'state', 'stored']) AS form, 2 * n AS rows_in, unnest([2 * n, keys, keys]) AS rows_out FROM sizes""",
    "silver_stream_clean": _SILVER_ROWS,
    "gold_stream_append": _GOLD_DAILY_UNCLEANED,
    "gold_stream_compacted": _BOTH_FORMS,
    "gold_stream_append_partitioned": _BOTH_FORMS,
    "gold_stream_snapshot": _GOLD_DAILY_UNCLEANED,
    "gold_stream_changes": _GOLD_DAILY_UNCLEANED,
    "gold_stream_event_time": _FINISHED_DAYS,
    "gold_stream_late": _FINISHED_DAYS,
    "gold_stream_late_counts": f"{_UNIQUE} SELECT count(*) AS flights, true AS some_late FROM unique_flights",
    "gold_stream_arrival": _GOLD_DAILY_UNCLEANED,
    "layers_stream": f"""{_UNIQUE} SELECT {_quoted(DAILY_ROUTE_KEY)}, count(*) AS flights_count
  FROM unique_flights GROUP BY {_quoted(DAILY_ROUTE_KEY)}""",
}

"""Flights derived from the supplied order tables (see FIXTURES.md, section 2)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.sources import read_batch

_DEP_DELAY = (
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL"
    " ELSE CAST((l_partkey*7 + l_linenumber*13) % 90 AS DOUBLE) - 20 END"
)
_ARR_DELAY = (
    "CASE WHEN l_orderkey % 13 = 0 THEN NULL"
    " ELSE CAST((l_partkey*5 + l_linenumber*17) % 80 AS DOUBLE) - 25 END"
)

# Flight column -> expression over the joined order tables. Each
# expression reads the same in Spark SQL and in the SQL of the result check.
FLIGHT_EXPRESSIONS = {
    "Year": "CAST(year(l_shipdate) AS BIGINT)",
    "Month": "CAST(month(l_shipdate) AS BIGINT)",
    "DayofMonth": "CAST(day(l_shipdate) AS BIGINT)",
    "FlightDate": "CAST(l_shipdate AS DATE)",
    "Marketing_Airline_Network": "o_orderpriority",
    "OriginCityName": "origin_region",
    "DestCityName": "dest_region",
    "CRSDepTime": "CAST((l_linenumber % 4) * 600 AS BIGINT)",
    "DepTime": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST((l_linenumber % 4) * 600 + 5 AS BIGINT) END",
    "DepDelay": _DEP_DELAY,
    "DepDelayMinutes": f"CASE WHEN ({_DEP_DELAY}) < 0 THEN CAST(0 AS DOUBLE) ELSE {_DEP_DELAY} END",
    "TaxiOut": "CAST(l_partkey % 30 AS DOUBLE)",
    "WheelsOff": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST((l_linenumber % 4) * 600 + 20 AS BIGINT) END",
    "WheelsOn": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST((l_linenumber % 4) * 600 + 240 AS BIGINT) END",
    "TaxiIn": "CAST(l_partkey % 17 AS DOUBLE)",
    "CRSArrTime": "CAST((l_linenumber % 4) * 600 + 250 AS BIGINT)",
    "ArrTime": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST((l_linenumber % 4) * 600 + 255 AS BIGINT) END",
    "ArrDelay": _ARR_DELAY,
    "ArrDelayMinutes": f"CASE WHEN ({_ARR_DELAY}) < 0 THEN CAST(0 AS DOUBLE) ELSE {_ARR_DELAY} END",
    "CRSElapsedTime": "CAST(l_partkey % 300 + 40 AS DOUBLE)",
    "ActualElapsedTime": "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_partkey % 310 + 35 AS DOUBLE) END",
    "AirTime": "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity * 6 END",
    "Distance": "l_quantity * 50",
    "DistanceGroup": "CAST(floor(l_quantity / 5) AS BIGINT) + 1",
    "CarrierDelay": "CASE WHEN l_partkey % 4 = 0 THEN CAST(l_partkey % 40 AS DOUBLE) ELSE NULL END",
    "WeatherDelay": "CASE WHEN l_partkey % 5 = 0 THEN CAST(l_partkey % 35 AS DOUBLE) ELSE NULL END",
    "NASDelay": "CASE WHEN l_partkey % 6 = 0 THEN CAST(l_partkey % 50 AS DOUBLE) ELSE NULL END",
    "SecurityDelay": "CASE WHEN l_partkey % 7 = 0 THEN CAST(l_partkey % 21 AS DOUBLE) ELSE NULL END",
    "LateAircraftDelay": "CASE WHEN l_partkey % 8 = 0 THEN CAST(l_partkey % 56 AS DOUBLE) ELSE NULL END",
    "__index_level_0__": "CAST(l_orderkey * 10 + l_linenumber AS BIGINT)",
}

# A total order over the derived rows, for repeatable duplicate removal.
FLIGHT_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
)


# The columns used of each supplied table. Declaring them saves a
# job per table that would only read the files' schema.
TABLE_SCHEMAS = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
        " l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def derive_flights(spark: SparkSession, tables_dir: str, keep_order: bool = False) -> DataFrame:
    """Thirty-column flights, one row per ``lineitem`` row.

    Orders meet their customers before they meet ``lineitem``, so the largest
    table is shuffled at most once per join key. No side is hinted: Spark
    broadcasts what its size check allows, at planning or from shuffle sizes.
    ``keep_order`` carries the ``FLIGHT_ORDER`` columns along.
    """

    def table(name: str) -> DataFrame:
        return read_batch(spark, f"{tables_dir}/{name}.parquet", schema=TABLE_SCHEMAS[name])

    places = table("nation").join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    origins = places.select("n_nationkey", F.col("r_name").alias("origin_region"))
    destinations = places.select("n_nationkey", F.col("r_name").alias("dest_region"))
    bookings = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(destinations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderpriority", "dest_region")
    )
    joined = (
        table("lineitem")
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origins, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(bookings, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    flights = [f"{sql} AS `{name}`" for name, sql in FLIGHT_EXPRESSIONS.items()]
    return joined.selectExpr(*flights, *(FLIGHT_ORDER if keep_order else ()))

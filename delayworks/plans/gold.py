"""Gold layer: three aggregates over silver flights.

Each is one shuffle on the group keys behind a partial hash aggregate, so the
rows exchanged are bounded by groups times map tasks, however skewed the keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.functions import is_late, overall_delay, percent
from delayworks.schema import (
    DAILY_ROUTE_KEY,
    LATE_ARRIVAL_MINUTES,
    MONTHLY_CARRIER_KEY,
    ROUTE_CARRIER_KEY,
)


def daily_route_measures() -> list[Column]:
    """Measures per day and route, for the batch and the streaming plans."""
    flights = F.count("*")
    arrived_late = F.count_if(F.col("ArrDelayMinutes") > LATE_ARRIVAL_MINUTES)
    return [
        flights.alias("flights_count"),
        F.avg("DepDelayMinutes").alias("avg_dep_delay_minutes"),
        arrived_late.alias("arr_delay_gt15_count"),
        percent(arrived_late, flights).alias("arr_delay_gt15_pct"),
        F.avg("TaxiOut").alias("avg_taxi_out"),
        F.avg("TaxiIn").alias("avg_taxi_in"),
    ]


def _lateness_measures() -> list[Column]:
    flights, late = F.count("*"), F.count_if(is_late())
    return [
        flights.alias("total_flights"),
        late.alias("delay_flights"),
        percent(late, flights).alias("delay_rate_pct"),
    ]


def _distance_measures() -> list[Column]:
    return [
        F.sum("Distance").alias("total_distance_miles"),
        F.avg("Distance").alias("avg_distance_miles"),
    ]


def gold_daily_route(silver: DataFrame) -> DataFrame:
    """Flights, delays and taxi times per day and route."""
    return silver.groupBy(*DAILY_ROUTE_KEY).agg(*daily_route_measures())


def gold_monthly_carrier(silver: DataFrame) -> DataFrame:
    """Flights, lateness and distance per month and carrier."""
    return silver.groupBy(*MONTHLY_CARRIER_KEY).agg(
        *_lateness_measures(),
        F.avg("DepDelayMinutes").alias("avg_departure_delay_min"),
        F.avg("ArrDelayMinutes").alias("avg_arrival_delay_min"),
        *_distance_measures(),
    )


def gold_route_performance(silver: DataFrame) -> DataFrame:
    """Flights, lateness, air time and distance per route and carrier."""
    return silver.groupBy(*ROUTE_CARRIER_KEY).agg(
        *_lateness_measures(),
        F.avg(overall_delay()).alias("avg_overall_delay_min"),
        F.avg("AirTime").alias("avg_air_time_min"),
        *_distance_measures(),
    )


GOLD_PLANS = {
    "daily_route": gold_daily_route,
    "monthly_carrier": gold_monthly_carrier,
    "route_performance": gold_route_performance,
}

"""Silver layer: typed, de-duplicated, cleaned flights."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from delayworks.operators import clamp_min, conform, dedup, fill_nulls, flag_at_least
from delayworks.schema import (
    CLEANED_MEASURES,
    FLIGHT_KEY,
    FLIGHT_SCHEMA,
    LATE_ARRIVAL_MINUTES,
)


def clean_flights(df: DataFrame, measures: Sequence[str] = CLEANED_MEASURES) -> DataFrame:
    """Measures without NULL, NaN and negatives, and the ``is_delayed_15`` flag."""
    filled = fill_nulls(df, measures, 0)
    clamped = clamp_min(filled, measures, 0)
    return flag_at_least(clamped, "ArrDelayMinutes", LATE_ARRIVAL_MINUTES, "is_delayed_15")


def silver_transform(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Conform, remove duplicates, clean. One shuffle, on the flight key.

    ``order_by`` decides which copy of a flight survives; see ``dedup``.
    """
    typed = conform(df, FLIGHT_SCHEMA, on_error)
    return clean_flights(dedup(typed, FLIGHT_KEY, order_by))

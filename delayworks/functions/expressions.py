"""Built-in column expressions; all of them stay inside whole-stage codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

_SECONDS_PER_DAY = 86_400


def column(name: str) -> Column:
    """Column by exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def clamped(name: str, floor: float, dtype: DataType) -> Column:
    """The value, or ``floor`` where the value is below it. NULL and NaN pass through."""
    value = column(name)
    return F.when(value < floor, F.lit(floor).cast(dtype.simpleString())).otherwise(value)


def at_least(name: str, threshold: float) -> Column:
    """1 where the value reaches the threshold, else 0; NULL counts as not reached."""
    return F.when(column(name) >= threshold, 1).otherwise(0)


def is_late() -> Column:
    """Departure or arrival delay above zero, in three-valued logic."""
    return (F.col("DepDelayMinutes") > 0) | (F.col("ArrDelayMinutes") > 0)


def overall_delay() -> Column:
    """Both delays added; NULL if either is NULL, so an average skips the row."""
    return F.col("DepDelayMinutes") + F.col("ArrDelayMinutes")


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, as a double."""
    return part * 100 / whole


def flight_day_instant(name: str) -> Column:
    """Date to the instant of its midnight in UTC.

    Independent of the session time zone, so that one-day windows, which Spark
    aligns to UTC, hold exactly one calendar date each.
    """
    return F.timestamp_seconds(F.unix_date(column(name)).cast("long") * _SECONDS_PER_DAY)


def instant_day(instant: Column) -> Column:
    """Inverse of ``flight_day_instant``."""
    return F.date_from_unix_date((F.unix_seconds(instant) / _SECONDS_PER_DAY).cast("int"))

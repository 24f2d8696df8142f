"""Load-time columns."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.functions import column


def stamp_ingestion(
    df: DataFrame,
    names: Sequence[str] = ("ingestion_date",),
    run_date: date | None = None,
) -> DataFrame:
    """Put the run's date in front, once per name, replacing columns already so named.

    Without ``run_date`` the date is taken by Spark when the job (or the
    micro-batch) starts.
    """
    stamp = F.current_date() if run_date is None else F.lit(run_date)
    rest = [column(c) for c in df.columns if c not in names]
    return df.select(*(stamp.alias(name) for name in names), *rest)


def stamp_arrival_time(df: DataFrame, name: str = "eventTime") -> DataFrame:
    """Add the processing time of the job or micro-batch as a timestamp."""
    return df.withColumn(name, F.current_timestamp())

"""Daily batch jobs: read one layer, write the next, one action each.

Every job takes the run's date, so a run past midnight still meets its own
input. Errors are raised. Jobs return the path written. ``replace`` says what a job
replaces: the whole path (``"path"``), the partitions that it writes (``"partitions"``, for one table of
all run dates), or the whole table at once (``"version"``, for readers at any time). Jobs read
tables written either way.
"""

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from delayworks.operators import rescue_columns, stamp_ingestion
from delayworks.plans.gold import GOLD_PLANS
from delayworks.plans.silver import silver_transform
from delayworks.schema import FLIGHT_SCHEMA
from delayworks.sinks import read_current, write_batch, write_version
from delayworks.sources import dated_path, read_batch

REPLACE = ("path", "partitions", "version")
#: Rows that one task of a job's shuffle takes at most, however large the input grows.
ROWS_PER_TASK = 250_000
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles started meanwhile deal rows to so many partitions that none gets more than ``ROWS_PER_TASK`` of
    ``rows`` by an even key, or to the session's number if that is larger; the session's number comes back after."""
    given = spark.conf.get(_SHUFFLE_PARTITIONS)
    wanted = -(-rows // ROWS_PER_TASK)
    if wanted > int(given):
        spark.conf.set(_SHUFFLE_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_PARTITIONS, given)


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str], replace: str) -> None:
    if replace not in REPLACE:
        raise ValueError(f"replace must be one of {REPLACE}, not {replace!r}")
    if replace == "version":
        write_version(df, path, fmt, partition_by)
    else:
        write_batch(df, path, fmt, partition_by=partition_by, replace_partitions=replace == "partitions")


def bronze_batch(
    spark: SparkSession,
    input_path: str,
    output_template: str,
    run_date: date,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: str = "path",
    input_fmt: str | None = None,
    input_options: Mapping[str, str] | None = None,
    rescue_column: str | None = None,
) -> str:
    """Store the input as it is, stamped with the run's date.

    With a ``rescue_column`` it is fitted to the flight schema, and what does not fit, text
    records too that can't be parsed, goes into that column.
    """
    target = dated_path(output_template, run_date)
    raw = read_batch(spark, input_path, input_fmt or fmt, options=input_options, corrupt_records=rescue_column is not None)
    if rescue_column:
        raw = rescue_columns(raw, FLIGHT_SCHEMA, rescue_column)
    _write(stamp_ingestion(raw, run_date=run_date), target, fmt, partition_by, replace)
    return target


def silver_batch(
    spark: SparkSession,
    input_template: str,
    output_template: str,
    run_date: date,
    fmt: str = "parquet",
    order_by: Sequence[str | Column] | None = None,
    partition_by: Sequence[str] = (),
    replace: str = "path",
) -> str:
    """Store the silver form of the run's bronze flights.

    Its shuffle on the flight key takes more partitions as the bronze flights grow (see ``_shuffles_for``), so
    no task takes a share of all of them; for Parquet, the count of the rows reads only the files' footers.
    """
    target = dated_path(output_template, run_date)
    bronze = read_current(spark, dated_path(input_template, run_date), fmt)
    with _shuffles_for(spark, bronze.count()):
        _write(silver_transform(bronze, order_by), target, fmt, partition_by, replace)
    return target


def gold_batch(
    spark: SparkSession,
    kind: str,
    input_template: str,
    output_template: str,
    run_date: date,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: str = "path",
) -> str:
    """Store one of ``GOLD_PLANS`` over the run's silver flights."""
    target = dated_path(output_template, run_date)
    silver = read_current(spark, dated_path(input_template, run_date), fmt)
    _write(GOLD_PLANS[kind](silver), target, fmt, partition_by, replace)
    return target

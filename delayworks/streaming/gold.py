"""Daily route measures on a stream.

A micro-batch is stored in a folder of its own (see ``delayworks.sinks.batches``), in one of three
forms by output mode: ``append`` stores partial sums of the batch's rows, which readers add up;
``complete`` the whole result; ``update`` the changed groups. Two forms more store partial sums: by flight
date, where readers take the days that a stored watermark has passed and late rows lie apart
(see ``delayworks.streaming.late``), and by arrival, through a stateful aggregate that a watermark over the arrival time
empties.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayworks.functions import column, flight_day_instant, instant_day, percent
from delayworks.operators import dedup
from delayworks.plans.gold import daily_route_measures
from delayworks.schema import DAILY_ROUTE_KEY, FLIGHT_SCHEMA, LATE_ARRIVAL_MINUTES
from delayworks.sinks.batches import BATCH_COLUMN, compact, current_run, each_batch, manifest, read_folders, read_live, store
from delayworks.sources import read_batch
from delayworks.streaming.late import instant, read_late, split_late, watermark

# Averages of a day and route, and the columns they are taken of.
_AVERAGES = {
    "avg_dep_delay_minutes": "DepDelayMinutes",
    "avg_taxi_out": "TaxiOut",
    "avg_taxi_in": "TaxiIn",
}
_ADDED = ["flights", "late", *(f"{kind}_{c}" for c in _AVERAGES.values() for kind in ("sum", "n"))]

_KEY_FIELDS = [FLIGHT_SCHEMA[name] for name in DAILY_ROUTE_KEY]
_BATCH_FIELD = StructType().add(BATCH_COLUMN, "long").fields
PARTIAL_SCHEMA = StructType(
    [
        *_KEY_FIELDS,
        *(StructType().add(c, "double" if c.startswith("sum_") else "long")[0] for c in _ADDED),
        *_BATCH_FIELD,
    ]
)
MEASURE_TYPES = {"flights_count": "long", "arr_delay_gt15_count": "long"}
MEASURES = ("flights_count", "avg_dep_delay_minutes", "arr_delay_gt15_count", "arr_delay_gt15_pct", "avg_taxi_out", "avg_taxi_in")
RESULT_SCHEMA = StructType(
    [*_KEY_FIELDS, *(StructType().add(m, MEASURE_TYPES.get(m, "double"))[0] for m in MEASURES), *_BATCH_FIELD]
)


def daily_route_partials(silver: DataFrame, more_keys: Sequence[str] = ()) -> DataFrame:
    """Counts and sums per day and route, from which the measures of any union of rows follow."""
    columns: list[Column] = [
        F.count("*").alias("flights"),
        F.count_if(F.col("ArrDelayMinutes") > LATE_ARRIVAL_MINUTES).alias("late"),
    ]
    for column in _AVERAGES.values():
        columns += [F.sum(column).alias(f"sum_{column}"), F.count(column).alias(f"n_{column}")]
    return silver.groupBy(*more_keys, *DAILY_ROUTE_KEY).agg(*columns)


def added_up(partials: DataFrame) -> DataFrame:
    """One row per day and route of the counts and sums; the number is the latest one."""
    return partials.groupBy(*DAILY_ROUTE_KEY).agg(
        *(F.sum(c).alias(c) for c in _ADDED), F.max(BATCH_COLUMN).alias(BATCH_COLUMN)
    )


def latest(changes: DataFrame, keys: Sequence[str] = DAILY_ROUTE_KEY) -> DataFrame:
    """The latest version of every group."""
    return dedup(changes, keys, [F.col(BATCH_COLUMN).desc()])


def daily_route_by_event_time(silver: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Daily routes over one-day windows of a timestamp column, for append mode.

    A day is emitted once the watermark, the latest event time less ``delay``,
    has passed its end; rows that come later are dropped.
    """
    by_day = silver.withWatermark(event_time, delay).groupBy(
        F.window(event_time, "1 day").alias("day"), "OriginCityName", "DestCityName"
    )
    measured = by_day.agg(*daily_route_measures())
    day = instant_day(F.col("day.start"))
    dated = {
        "Year": F.year(day).cast("long"),
        "Month": F.month(day).cast("long"),
        "DayofMonth": F.dayofmonth(day).cast("long"),
    }
    return measured.withColumns(dated).select(
        *DAILY_ROUTE_KEY, *(c for c in measured.columns if c not in ("day", *DAILY_ROUTE_KEY))
    )


def _dated(silver: DataFrame, event_date: str) -> DataFrame:
    """The calendar columns as the flight date gives them."""
    day = column(event_date)
    parts = {"Year": F.year(day), "Month": F.month(day), "DayofMonth": F.dayofmonth(day)}
    return silver.withColumns({name: part.cast("long") for name, part in parts.items()})


def write_days(
    path: str, checkpoint: str, event_date: str, delay: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores partial sums by flight date; a day is late once the stored
    watermark has passed its end."""
    event = flight_day_instant(event_date)

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        timely, note = split_late(batch, batch_id, path, run, event, event + F.expr("INTERVAL '1 day'"), delay, fmt)
        store(daily_route_partials(_dated(timely, event_date)), run, batch_id, fmt, partition_by, note)

    return each_batch(path, checkpoint, write)


def read_days(spark: SparkSession, path: str, with_late: bool = False, event_date: str = "FlightDate") -> DataFrame:
    """The measures of the days that the stored watermark has passed, as they were when it did.

    ``with_late`` adds the late rows to their days. Late rows without a date belong to no day; see ``read_late``.
    """
    run = current_run(spark, path)
    mark = watermark(manifest(spark, run).notes) if run else None
    partials = read_live(spark, path, PARTIAL_SCHEMA)
    if mark is None:
        return measured(partials.limit(0))
    if with_late:
        late = read_late(spark, path)
        if event_date in late.columns:
            more = daily_route_partials(_dated(late.where(column(event_date).isNotNull()), event_date))
            partials = partials.unionByName(more.withColumn(BATCH_COLUMN, F.lit(None).cast("long")))
    day = F.make_date(*(F.col(c).cast("int") for c in DAILY_ROUTE_KEY[:3]))
    over = F.timestamp_seconds((F.unix_date(day).cast("long") + 1) * 86_400) <= instant(mark)
    return measured(partials.where(over))


def daily_route_by_arrival(silver: DataFrame, arrival: str, delay: str) -> DataFrame:
    """Partial sums per arrival time, day and route, for append mode.

    All rows of a micro-batch have one arrival time and none is ever late, so a group is emitted, and its
    state dropped, as soon as the watermark passes that time: with no ``delay``, at the end of the run.
    """
    return daily_route_partials(silver.withWatermark(arrival, delay), [arrival])


def read_arrivals(spark: SparkSession, path: str, arrival: str, fmt: str = "parquet") -> DataFrame:
    """The measures of all arrivals that ``gold_stream(by_arrival=True)`` has emitted."""
    schema = StructType([*(f for f in PARTIAL_SCHEMA if f.name != BATCH_COLUMN), *StructType().add(arrival, "timestamp").fields])
    return measured(read_batch(spark, path, fmt, schema).withColumn(BATCH_COLUMN, F.lit(None).cast("long")))


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The measures of all rows that an ``append`` stream has taken."""
    return measured(read_live(spark, path, PARTIAL_SCHEMA))


def measured(partials: DataFrame) -> DataFrame:
    """The measures of all rows that went into partial sums."""
    return added_up(partials).select(
        *DAILY_ROUTE_KEY,
        F.col("flights").alias("flights_count"),
        _average("avg_dep_delay_minutes"),
        F.col("late").alias("arr_delay_gt15_count"),
        percent(F.col("late"), F.col("flights")).alias("arr_delay_gt15_pct"),
        _average("avg_taxi_out"),
        _average("avg_taxi_in"),
    )


def _average(name: str) -> Column:
    column = _AVERAGES[name]
    return (F.col(f"sum_{column}") / F.nullif(F.col(f"n_{column}"), F.lit(0))).alias(name)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The whole result of a ``complete`` stream: the newest folder of the newest run."""
    run = current_run(spark, path)
    folders, fmt = ((held := manifest(spark, run)).folders[-1:], held.fmt) if run else ((), "parquet")
    return read_folders(spark, run or path, folders, RESULT_SCHEMA, fmt).drop(BATCH_COLUMN)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of every group of an ``update`` stream."""
    return latest(read_live(spark, path, RESULT_SCHEMA)).drop(BATCH_COLUMN)


def compact_totals(spark: SparkSession, path: str, remove: bool = False, **how) -> None:
    """Fold the partial sums of an ``append`` stream, or of one by flight date, into one folder."""
    compact(spark, path, added_up, PARTIAL_SCHEMA, remove=remove, **how)


def compact_changes(spark: SparkSession, path: str, remove: bool = False, **how) -> None:
    """Fold the versions of an ``update`` stream into one folder of the latest ones."""
    compact(spark, path, latest, RESULT_SCHEMA, remove=remove, **how)

"""Streaming jobs of the three layers.

Each takes an input and an output configuration, runs what is new to its
checkpoint, waits, and returns the finished query. Errors are raised.
"""

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructField, StructType

from delayworks.operators import dedup_stream, rescue_columns, stamp_arrival_time, stamp_ingestion
from delayworks.plans.gold import gold_daily_route
from delayworks.plans.silver import clean_flights
from delayworks.schema import FLIGHT_KEY, FLIGHT_SCHEMA
from delayworks.sinks import run_available
from delayworks.sinks.batches import read_live, write_batches
from delayworks.sources import read_batch, read_new_paths, united_schemas
from delayworks.streaming.config import StreamInput, StreamOutput
from delayworks.streaming.counts import counted, counts_of, store_counts
from delayworks.streaming.gold import daily_route_by_arrival, daily_route_partials, write_days
from delayworks.streaming.silver import write_new_flights

# Both stamps of streaming bronze, the event-time column of
# streaming gold and the watermark delay over flight dates.
BRONZE_STAMPS = ("ingestion_date", "fecha")
EVENT_TIME_COLUMN = "eventTime"
WATERMARK_DELAY = "10 minutes"
RESCUE_COLUMN = "_rescued_data"


def bronze_stream(
    spark: SparkSession,
    input_config: Mapping,
    output_config: Mapping,
    schema: StructType | None = None,
    run_date: date | None = None,
    by_file_schema: bool = False,
) -> StreamingQuery:
    """Store new files as they are, stamped with the run's date.

    With a rescue column configured, the frame is fitted to the flight schema. ``by_file_schema``
    then reads each file by its own schema, so that columns which come up later, or files that give
    a column another type, are rescued too; see ``read_bronze``.
    """
    sink = StreamOutput.from_config(output_config)
    source = StreamInput.from_config(input_config).prepare(spark, sink.checkpoint)
    if by_file_schema:
        return _bronze_by_file_schema(spark, source, sink, run_date)
    raw = source.read(spark, schema)
    if source.rescue_column:
        raw = rescue_columns(raw, FLIGHT_SCHEMA, source.rescue_column)
    stamped = stamp_ingestion(counted(raw), BRONZE_STAMPS, run_date)
    return _with_counts(spark, sink, run_available(spark, sink.write(counted(stamped, out=True))))


def _bronze_by_file_schema(
    spark: SparkSession, source: StreamInput, sink: StreamOutput, run_date: date | None
) -> StreamingQuery:
    rescue = source.rescue_column or RESCUE_COLUMN

    def fitted(paths: DataFrame) -> DataFrame:
        files = [row["path"] for row in paths.collect()]  # as many as the cap on files lets in
        given = {**source.options, "mergeSchema": "true"}
        groups = (
            read_batch(spark, group, source.fmt, schema, given, corrupt_records=True)
            for schema, group in united_schemas(spark, files, source.fmt, source.options)
        )
        frames = [rescue_columns(raw, FLIGHT_SCHEMA, rescue) for raw in groups]
        return stamp_ingestion(reduce(DataFrame.unionByName, frames), BRONZE_STAMPS, run_date)

    new = read_new_paths(spark, source.path, source.max_files_per_trigger, source.options)
    writer = new.writeStream.option("checkpointLocation", sink.checkpoint).foreachBatch(
        write_batches(sink.path, sink.checkpoint, sink.fmt, sink.partition_by, fitted)
    )
    return run_available(spark, writer)


def read_bronze(spark: SparkSession, path: str, rescue_column: str = RESCUE_COLUMN) -> DataFrame:
    """What ``bronze_stream`` has stored with ``by_file_schema``."""
    stamps = [StructField(name, DateType()) for name in BRONZE_STAMPS]
    rest = [f for f in FLIGHT_SCHEMA if f.name not in BRONZE_STAMPS]
    schema = StructType([*stamps, *rest, StructField(rescue_column, StringType())])
    return read_live(spark, path, schema)


def silver_stream(
    spark: SparkSession,
    input_config: Mapping,
    output_config: Mapping,
    schema: StructType | None = None,
    clean: bool = False,
    hot_key_splits: int = 256,
    event_date: str = "FlightDate",
    delay: str | None = None,
    stored: bool = False,
) -> StreamingQuery:
    """Store the first arrival of every flight, across runs of one checkpoint.

    ``clean=True`` also applies the cleaning of batch silver. By default Spark's state store knows the
    keys. ``stored`` looks them up in the table itself instead, which costs no state and is the form to
    prefer; it is read by ``read_silver`` and folded by ``compact_silver``. With a ``delay``, which implies ``stored``, flights
    that come behind the watermark over ``event_date`` are set apart; see ``read_late``.
    """
    sink = StreamOutput.from_config(output_config)
    raw = StreamInput.from_config(input_config).prepare(spark, sink.checkpoint).read(spark, schema)
    if stored or delay is not None:
        counts: list[tuple[int, int, int]] = []
        write = write_new_flights(sink.path, sink.checkpoint, sink.fmt, sink.partition_by, event_date, clean, delay, counts=counts)
        query = run_available(spark, raw.writeStream.option("checkpointLocation", sink.checkpoint).foreachBatch(write))
        store_counts(spark, sink.path, counts)
        return query
    flights = counted(dedup_stream(counted(raw), FLIGHT_KEY, hot_key_splits=hot_key_splits), out=True)
    # The state keeps its shuffle partitions; the sink writes a file per core and micro-batch, not one per
    # partition, so a stream that reads this table a few files at a time takes few micro-batches.
    flights = flights.coalesce(spark.sparkContext.defaultParallelism)
    return _with_counts(spark, sink, run_available(spark, sink.write(clean_flights(flights) if clean else flights)))


def _with_counts(spark: SparkSession, sink: StreamOutput, query: StreamingQuery) -> StreamingQuery:
    """The query, after the counts of its run have been stored; see ``read_counts``."""
    store_counts(spark, sink.path, counts_of(query))
    return query


def gold_stream(
    spark: SparkSession,
    input_config: Mapping,
    output_config: Mapping,
    schema: StructType | None = None,
    event_date: str = "FlightDate",
    delay: str | None = None,
    by_event_time: bool = False,
    by_arrival: bool = False,
) -> StreamingQuery:
    """Store daily route measures; the output mode selects the form.

    ``append``: partial sums per micro-batch, see ``read_totals``. It keeps no state and drops no
    row, whatever order files come in, and is the form to prefer. ``complete``: see
    ``read_snapshot``. ``update``: see ``read_changes``. ``by_event_time`` tells days that a stored watermark over
    ``event_date``, ``delay`` behind the latest one, has passed from those still open, and sets rows apart
    that come for a passed day; see ``read_days`` and ``read_late``. ``by_arrival`` aggregates by
    arrival time under a watermark ``delay`` behind it (none by default), which needs no rows set apart, as none is
    late; see ``read_arrivals``.
    """
    sink = StreamOutput.from_config(output_config)
    silver = StreamInput.from_config(input_config).prepare(spark, sink.checkpoint).read(spark, schema)
    if by_arrival:
        arrived = stamp_arrival_time(counted(silver), EVENT_TIME_COLUMN)
        daily = counted(daily_route_by_arrival(arrived, EVENT_TIME_COLUMN, delay or "0 seconds"), out=True)
        return _with_counts(spark, sink, run_available(spark, sink.write(daily)))
    rows = silver
    if by_event_time:
        write = write_days(sink.path, sink.checkpoint, event_date, delay or WATERMARK_DELAY, sink.fmt, sink.partition_by)
    elif sink.output_mode == "append":
        write = write_batches(sink.path, sink.checkpoint, sink.fmt, sink.partition_by, daily_route_partials)
    else:
        rows = gold_daily_route(silver)
        write = write_batches(sink.path, sink.checkpoint, sink.fmt, sink.partition_by)
    writer = rows.writeStream.outputMode(sink.output_mode).option("checkpointLocation", sink.checkpoint).foreachBatch(write)
    return run_available(spark, writer)

"""One query per operator, plan and job, over flights derived from the whole tables.

Jobs write below ``scratch_dir`` and the query reads back what they stored.
"""

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from delayworks.fixtures import FLIGHT_EXPRESSIONS, FLIGHT_ORDER, derive_flights
from delayworks.functions import is_late, overall_delay, percent
from delayworks.operators import (
    clamp_min,
    conform,
    dedup,
    fill_nulls,
    flag_at_least,
    profile_step,
    rescue_columns,
    stamp_arrival_time,
    stamp_ingestion,
)
from delayworks.plans import (
    bronze_batch,
    gold_batch,
    gold_daily_route,
    gold_monthly_carrier,
    gold_route_performance,
    silver_batch,
    silver_transform,
)
from delayworks.schema import (
    CLEANED_MEASURES,
    DAILY_ROUTE_KEY,
    FLIGHT_KEY,
    FLIGHT_SCHEMA,
    LATE_ARRIVAL_MINUTES,
)
from delayworks.scratch import scratch_dir
from delayworks.sinks import read_current, run_available, write_batch, write_stream
from delayworks.sources import dated_path, infer_stream_schema, read_batch, read_stream
from delayworks.streaming import (
    EVENT_TIME_COLUMN,
    bronze_stream,
    compact_changes,
    compact_silver,
    compact_totals,
    gold_stream,
    read_arrivals,
    read_bronze,
    read_changes,
    read_counts,
    read_days,
    read_late,
    read_silver,
    read_snapshot,
    read_totals,
    silver_stream,
)

RUN_DATE = date(2024, 3, 15)
_RAW = tuple(FLIGHT_EXPRESSIONS)
_LANDED: dict[tuple[str, ...], str] = {}


# --- inputs -----------------------------------------------------------------


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derive_flights(spark, sf_dir, keep_order=True)
    return dedup(flights, FLIGHT_KEY, FLIGHT_ORDER).select(*_RAW)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derive_flights(spark, sf_dir, keep_order=True)
    return silver_transform(flights, FLIGHT_ORDER).drop(*FLIGHT_ORDER)


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights as strings, with values that do not fit and a column not declared."""
    flights = derive_flights(spark, sf_dir, keep_order=True)
    planted = {
        "CRSDepTime": F.when(F.col("l_orderkey") % 19 == 0, "x").otherwise(F.col("CRSDepTime").cast("string")),
        "Distance": F.when(F.col("l_orderkey") % 23 == 0, "far").otherwise(F.col("Distance").cast("string")),
    }
    parity = F.when(F.col("l_partkey") % 2 == 0, "even").otherwise("odd")
    return flights.select(
        *(planted.get(c, F.col(c).cast("string")).alias(c) for c in _RAW),
        F.when(F.col("l_partkey") % 3 == 0, parity).alias("surprise"),
    )


def _as_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derive_flights(spark, sf_dir)
    return flights.select(*(F.col(c).cast("string").alias(c) for c in _RAW))


FILES = 8
BATCHES = 4
ROWS_PER_FILE = 250_000


def _spread(df: DataFrame, least: int = FILES) -> DataFrame:
    """The rows in so many files at least, and in more as they grow, so that no task takes more than
    ``ROWS_PER_FILE`` rows; every file with rows of all dates."""
    return df.repartition(max(least, -(-df.count() // ROWS_PER_FILE)))


_LANDINGS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flights": derive_flights,
    "ordered": lambda spark, sf_dir: derive_flights(spark, sf_dir, keep_order=True),
    "unique": _unique,
    "damaged": damaged,
}


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A folder of Parquet files for jobs to start from, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _LANDED:
        path = scratch_dir(spark, f"landing-{kind}")
        write_batch(_spread(_LANDINGS[kind](spark, sf_dir)), path)
        _LANDED[key] = path
    return _LANDED[key]


def landed_by_year(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Files of consecutive flight dates, the earliest first by their times: for streams that a watermark bounds.

    All are written at once. No date lies in two files, so whatever part a micro-batch takes, no later file has
    rows behind the watermark of an earlier one.
    """
    key = (spark.sparkContext.applicationId, sf_dir, f"{kind}-by-year")
    if key not in _LANDED:
        path, flights = scratch_dir(spark, f"landing-{kind}-years"), read_batch(spark, landed(spark, sf_dir, kind))
        number = max(FILES, -(-flights.count() // ROWS_PER_FILE))
        write_batch(flights.repartitionByRange(number, "FlightDate"), path)
        _set_times_by_name(spark, path)
        _LANDED[key] = path
    return _LANDED[key]


def _set_times_by_name(spark: SparkSession, path: str) -> None:
    """Give the files of a folder times a second apart, the last one's the present, in the order of their names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("part-")]
    parts.sort(key=lambda p: int(p.getName().split("-")[1]))
    now = int(datetime.now(timezone.utc).timestamp() * 1000)
    for behind, part in enumerate(reversed(parts)):
        files.setTimes(part, now - behind * 1000, -1)


def many(query: StreamingQuery, batches: int = BATCHES) -> StreamingQuery:
    """The query, which must have taken rows in so many micro-batches at least."""
    taken = sum(p["numInputRows"] > 0 for p in query.recentProgress)
    if taken < batches:
        raise AssertionError(f"{taken} micro-batches with rows, {batches} expected")
    return query


def _files(spark: SparkSession, path: str) -> int:
    """The number of files of a folder or pattern that streams would take; none are read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    return len(spark.read.format("binaryFile").load(path).inputFiles()) if there else 0


def _stream_config(
    source: str,
    folder: str,
    output_mode: str = "append",
    rescue_column: str | None = None,
    file_cap: int = 2,
    files: int = FILES,
    **output,
) -> tuple[dict, dict]:
    """The job's two dictionaries. ``file_cap`` is meant for the least landing of ``FILES`` files; where a run
    meets more ``files``, the cap grows with them, so a micro-batch takes the same share of the run's input."""
    cap = max(file_cap, files * file_cap // FILES)
    options = {"cloudFiles.format": "parquet", "cloudFiles.maxFilesPerTrigger": str(cap)}
    if rescue_column:
        options["cloudFiles.rescuedDataColumn"] = rescue_column
    return (
        {"datasetInputPath": source, "autoloaderOptions": options},
        {
            "format": "parquet",
            "datasetOuputPath": f"{folder}/table",
            "checkpointPath": f"{folder}/checkpoint",
            "outputMode": output_mode,
            **output,
        },
    )


# --- operators --------------------------------------------------------------


def q_stamp_ingestion(spark, sf_dir):
    return stamp_ingestion(derive_flights(spark, sf_dir), run_date=RUN_DATE)


def q_stamp_arrival_time(spark, sf_dir):
    """Arrival times as a stream stores them: a timestamp in every row, one per micro-batch."""
    folder, path = scratch_dir(spark, "arrival"), landed(spark, sf_dir, "flights")
    schema = infer_stream_schema(spark, path)
    stream = stamp_arrival_time(read_stream(spark, path, schema, max_files_per_trigger=2))
    query = many(run_available(spark, write_stream(stream, f"{folder}/table", f"{folder}/checkpoint")))
    batches = sum(p["numInputRows"] > 0 for p in query.recentProgress)
    return read_batch(spark, f"{folder}/table").agg(
        F.count("*").alias("row_count"),
        F.count("eventTime").alias("stamped"),
        F.max(F.typeof("eventTime")).alias("stamp_type"),
        (F.count_distinct("eventTime") == batches).alias("one_per_batch"),
    )


def q_stamp_today(spark, sf_dir):
    """Stored flights stamped by Spark's own date: the day of the run, as the client sees it."""
    folder, before = scratch_dir(spark, "today"), datetime.now(timezone.utc).date()
    write_batch(stamp_ingestion(derive_flights(spark, sf_dir)), folder)
    days = [before - timedelta(days=1), before, datetime.now(timezone.utc).date() + timedelta(days=1)]
    return read_batch(spark, folder).agg(
        F.count("*").alias("row_count"),
        F.count_distinct("ingestion_date").alias("days"),
        F.max(F.typeof("ingestion_date")).alias("stamp_type"),
        F.min(F.col("ingestion_date").isin(days)).alias("is_today"),
    )


def q_ignore_missing_files(spark, sf_dir):
    """Flights of line numbers above 1: the folder of the others goes after the read was planned."""
    folder = scratch_dir(spark, "missing")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    paths = [f"{folder}/first", f"{folder}/rest"]
    for path, chosen in zip(paths, (F.col("l_linenumber") == 1, F.col("l_linenumber") > 1)):
        write_batch(flights.where(chosen).select(*_RAW), path)
    planned = read_batch(spark, paths, ignore_missing_files=True)
    gone = spark._jvm.org.apache.hadoop.fs.Path(paths[0])
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return planned


def q_conform(spark, sf_dir):
    return conform(_as_strings(spark, sf_dir), FLIGHT_SCHEMA)


def q_conform_null_on_error(spark, sf_dir):
    return conform(damaged(spark, sf_dir), FLIGHT_SCHEMA, on_error="null").drop("surprise")


def q_fill_nulls(spark, sf_dir):
    return fill_nulls(derive_flights(spark, sf_dir), CLEANED_MEASURES, 0)


def q_clamp_min(spark, sf_dir):
    return clamp_min(derive_flights(spark, sf_dir), CLEANED_MEASURES, 0)


def q_delay_flag(spark, sf_dir):
    flights = derive_flights(spark, sf_dir)
    return flag_at_least(flights, "ArrDelayMinutes", LATE_ARRIVAL_MINUTES, "is_delayed_15")


def q_rescue_columns(spark, sf_dir):
    return rescue_columns(damaged(spark, sf_dir), FLIGHT_SCHEMA)


def q_scalar_expressions(spark, sf_dir):
    return derive_flights(spark, sf_dir, keep_order=True).select(
        *FLIGHT_KEY,
        *FLIGHT_ORDER,
        (F.col("ArrDelayMinutes") > LATE_ARRIVAL_MINUTES).alias("beyond_15"),
        (F.col("ArrDelayMinutes") >= LATE_ARRIVAL_MINUTES).alias("reaches_15"),
        (F.col("DepDelay") < 0).alias("early"),
        is_late().alias("late"),
        F.when(is_late(), 1).otherwise(0).alias("late_flag"),
        overall_delay().alias("overall_delay"),
        percent(F.col("CRSDepTime"), F.nullif(F.col("CRSArrTime"), F.lit(0))).alias("clock_pct"),
        F.col("Distance").cast("long").alias("distance_whole"),
    )


def q_aggregate_functions(spark, sf_dir):
    rows, late = F.count("*"), F.count_if(is_late())
    return derive_flights(spark, sf_dir).groupBy("Marketing_Airline_Network").agg(
        rows.alias("row_count"),
        F.avg("ArrDelay").alias("avg_column"),
        F.avg(F.col("DepDelay") + F.col("ArrDelay")).alias("avg_expression"),
        F.sum("AirTime").alias("sum_column"),
        late.alias("conditional_count"),
        percent(late, rows).alias("ratio_pct"),
    )


def q_dedup_any_row(spark, sf_dir):
    return dedup(derive_flights(spark, sf_dir), FLIGHT_KEY).select(*FLIGHT_KEY)


def q_profile_counts(spark, sf_dir):
    path = scratch_dir(spark, "profile")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    return profile_step(flights, lambda f: silver_transform(f, FLIGHT_ORDER), lambda f: write_batch(f, path))


# --- plans ------------------------------------------------------------------


def q_gold_daily_route(spark, sf_dir):
    return gold_daily_route(_silver(spark, sf_dir))


def q_gold_monthly_carrier(spark, sf_dir):
    return gold_monthly_carrier(_silver(spark, sf_dir))


def q_gold_route_performance(spark, sf_dir):
    return gold_route_performance(_silver(spark, sf_dir))


# --- batch jobs -------------------------------------------------------------


def q_dated_path_roundtrip(spark, sf_dir):
    path = dated_path(f"{scratch_dir(spark, 'dated')}/flights_YYYY_MM_DD.parquet", RUN_DATE)
    write_batch(derive_flights(spark, sf_dir), path)
    return read_batch(spark, path)


def q_partitioned_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    daily = gold_daily_route(_silver(spark, sf_dir))
    write_batch(daily, path, partition_by=["OriginCityName"])
    return read_batch(spark, path, schema=daily.schema)


def q_partition_value_kept(spark, sf_dir):
    """Partition values that look like numbers read back as the strings they were."""
    path = scratch_dir(spark, "padded")
    code = F.lpad((F.col("CRSDepTime") / 60).cast("int").cast("string"), 3, "0")
    daily = derive_flights(spark, sf_dir).groupBy(code.alias("hour_code")).agg(F.count("*").alias("flights"))
    write_batch(daily, path, partition_by=["hour_code"])
    schema = StructType([StructField("flights", daily.schema["flights"].dataType), StructField("hour_code", StringType())])
    return read_batch(spark, path, schema=schema)


def q_bronze_batch(spark, sf_dir):
    target = f"{scratch_dir(spark, 'bronze')}/bronze_YYYY_MM_DD.parquet"
    return read_batch(spark, bronze_batch(spark, landed(spark, sf_dir, "flights"), target, RUN_DATE))


def _stored_silver(spark: SparkSession, sf_dir: str) -> str:
    """Bronze and silver jobs, one after the other; the template of the silver path."""
    folder = scratch_dir(spark, "layers")
    bronze, silver = f"{folder}/bronze_YYYY_MM_DD.parquet", f"{folder}/silver_YYYY_MM_DD.parquet"
    bronze_batch(spark, landed(spark, sf_dir, "ordered"), bronze, RUN_DATE)
    silver_batch(spark, bronze, silver, RUN_DATE, order_by=FLIGHT_ORDER)
    return silver


def q_silver_batch(spark, sf_dir):
    path = dated_path(_stored_silver(spark, sf_dir), RUN_DATE)
    return read_batch(spark, path).drop(*FLIGHT_ORDER)


def _gold_job(kind: str):
    def query(spark, sf_dir):
        target = f"{scratch_dir(spark, 'gold')}/{kind}_YYYY_MM_DD.parquet"
        silver = _stored_silver(spark, sf_dir)
        return read_batch(spark, gold_batch(spark, kind, silver, target, RUN_DATE))

    return query


def q_rerun_of_one_date(spark, sf_dir):
    """One bronze table of three run dates; the job of the second date runs again on corrected flights."""
    folder = scratch_dir(spark, "rerun")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    runs = [(0, 0.0), (1, 0.0), (2, 0.0), (1, 1.0)]
    for number, (part, more) in enumerate(runs):
        chosen = flights.where(F.col("l_linenumber") % 3 == part).withColumn("Distance", F.col("Distance") + more)
        write_batch(chosen.select(*_RAW), f"{folder}/in/{number}")
        day = RUN_DATE + timedelta(days=part)
        how = {"partition_by": ["ingestion_date"], "replace": "partitions"}
        bronze_batch(spark, f"{folder}/in/{number}", f"{folder}/bronze", day, **how)
    return read_batch(spark, f"{folder}/bronze", schema=stamp_ingestion(flights.select(*_RAW), run_date=RUN_DATE).schema)


def q_versioned_layers(spark, sf_dir):
    """Three layers whose tables are replaced at once; the second run replaces what the first one stored."""
    folder = scratch_dir(spark, "versions")
    paths = [f"{folder}/{layer}" for layer in ("bronze", "silver", "gold")]
    source = landed(spark, sf_dir, "ordered")
    write_batch(read_batch(spark, source).limit(10), f"{folder}/first")
    for raw in (f"{folder}/first", source):
        bronze_batch(spark, raw, paths[0], RUN_DATE, replace="version")
        silver_batch(spark, paths[0], paths[1], RUN_DATE, order_by=FLIGHT_ORDER, replace="version")
        gold_batch(spark, "daily_route", paths[1], paths[2], RUN_DATE, partition_by=["OriginCityName"], replace="version")
    return read_current(spark, paths[2])


def _with_broken_lines(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Flights as JSON lines, some of them broken off."""
    flights = derive_flights(spark, sf_dir, keep_order=True)
    broken = F.concat(F.lit("{broken "), F.concat_ws(" ", *FLIGHT_ORDER))
    line = F.when(F.col("l_orderkey") % 29 == 0, broken).otherwise(F.to_json(F.struct(*_RAW)))
    # gzip: the lines take a fraction of the disk; files stay small enough for one task each
    _spread(flights.select(line.alias("value"))).write.option("compression", "gzip").text(path)
    return path


def q_bronze_batch_broken_lines(spark, sf_dir):
    folder = scratch_dir(spark, "broken-batch")
    how = {"input_fmt": "json", "rescue_column": "_rescued_data"}
    return read_batch(spark, bronze_batch(spark, _with_broken_lines(spark, sf_dir, f"{folder}/in"), f"{folder}/out", RUN_DATE, **how))


def _broken_lines_stream(by_file_schema: bool):
    def query(spark, sf_dir):
        folder = scratch_dir(spark, "broken-stream")
        path = _with_broken_lines(spark, sf_dir, f"{folder}/in")
        job = _stream_config(path, folder, rescue_column="_rescued_data", files=_files(spark, path))
        job[0]["autoloaderOptions"]["cloudFiles.format"] = "json"
        many(bronze_stream(spark, *job, run_date=RUN_DATE, by_file_schema=by_file_schema))
        return read_bronze(spark, f"{folder}/table") if by_file_schema else read_batch(spark, f"{folder}/table")

    return query


# --- streaming jobs ---------------------------------------------------------


def _add_files(df: DataFrame, path: str) -> int:
    """Add the rows in new files; the number of them."""
    before = _files(df.sparkSession, path)
    write_batch(_spread(df), path, mode="append")
    return _files(df.sparkSession, path) - before


def _set_age(spark: SparkSession, path: str, days: int) -> None:
    """Set the files of a folder back in time."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    when = int(datetime.now(timezone.utc).timestamp() * 1000) - days * 86_400_000
    for status in files.listStatus(folder):
        files.setTimes(status.getPath(), when, -1)


def q_bronze_stream(spark, sf_dir):
    folder = scratch_dir(spark, "bronze-stream")
    many(bronze_stream(spark, *_stream_config(landed(spark, sf_dir, "flights"), folder), run_date=RUN_DATE))
    return read_batch(spark, f"{folder}/table")


def q_bronze_stream_backfill(spark, sf_dir):
    """The second run's files are a month older than those of the first."""
    folder = scratch_dir(spark, "bronze-backfill")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    parts = [flights.where(chosen).select(*_RAW) for chosen in ("l_linenumber % 2 = 1", "l_linenumber % 2 = 0")]
    job = _stream_config(f"{folder}/in/*", folder)
    for number, part in enumerate(parts):
        write_batch(_spread(part), f"{folder}/in/{number}")
        _set_age(spark, f"{folder}/in/{number}", 30 * number)
        many(bronze_stream(spark, *job, run_date=RUN_DATE))
    return read_batch(spark, f"{folder}/table")


def q_bronze_stream_archived(spark, sf_dir):
    """Three runs whose consumed files go to an archive; the second run's files come with times of a month ago."""
    folder = scratch_dir(spark, "bronze-archived")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    job = _stream_config(f"{folder}/in", folder, file_cap=1)
    job[0]["autoloaderOptions"]["archivePath"] = f"{folder}/archive"
    for number in range(3):
        part = _spread(flights.where(F.col("l_linenumber") % 3 == number).select(*_RAW), BATCHES)
        write_batch(part, f"{folder}/new/{number}")
        _set_age(spark, f"{folder}/new/{number}", 30 * (number == 1))
        _move_files(spark, f"{folder}/new/{number}", f"{folder}/in")
        many(bronze_stream(spark, *job, run_date=RUN_DATE))
    left = spark.read.format("binaryFile").load(f"{folder}/in").select("path").count()
    if left > 1:
        raise AssertionError(f"{left} files are left in the source, 1 of the last micro-batch expected")
    return read_batch(spark, f"{folder}/table")


def _move_files(spark: SparkSession, path: str, target: str) -> None:
    """Move the Parquet files of a folder, with their times."""
    source, into = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(into)
    for status in files.listStatus(source):
        if status.getPath().getName().endswith(".parquet"):
            files.rename(status.getPath(), into)


def q_bronze_stream_rescued(spark, sf_dir):
    folder = scratch_dir(spark, "bronze-stream-rescued")
    path = landed(spark, sf_dir, "damaged")
    job = _stream_config(path, folder, rescue_column="_rescued_data", files=_files(spark, path))
    many(bronze_stream(spark, *job, run_date=RUN_DATE))
    return read_batch(spark, f"{folder}/table")


def q_bronze_stream_drift(spark, sf_dir):
    """Files of three shapes: as declared, with one more column, with distances as strings."""
    folder = scratch_dir(spark, "bronze-drift")
    flights = derive_flights(spark, sf_dir, keep_order=True)
    far = F.when(F.col("l_orderkey") % 23 == 0, "far").otherwise(F.col("Distance").cast("string"))
    shapes = (
        flights.where("l_linenumber % 3 = 0").select(*_RAW),
        flights.where("l_linenumber % 3 = 1").select(*_RAW, F.lit("more").alias("surprise")),
        flights.where("l_linenumber % 3 = 2").withColumn("Distance", far).select(*_RAW),
    )
    for shape in shapes:
        write_batch(_spread(shape, 3), f"{folder}/in", mode="append")
    job = _stream_config(f"{folder}/in", folder, rescue_column="_rescued_data")
    many(bronze_stream(spark, *job, run_date=RUN_DATE, by_file_schema=True))
    return read_bronze(spark, f"{folder}/table")


def q_silver_stream(spark, sf_dir):
    """The same flights delivered twice, in new files, one run each."""
    folder = scratch_dir(spark, "silver-stream")
    flights = read_batch(spark, landed(spark, sf_dir, "flights"))
    for _ in range(2):
        files = _add_files(flights, f"{folder}/in")
        many(silver_stream(spark, *_stream_config(f"{folder}/in", folder, files=files)))
    return read_batch(spark, f"{folder}/table").select(*FLIGHT_KEY)


def q_stream_counts(spark, sf_dir):
    """Rows in and out of both silver forms over two deliveries, and of bronze, summed over micro-batches."""
    folder, counts = scratch_dir(spark, "counts"), []
    flights = read_batch(spark, landed(spark, sf_dir, "flights"))
    for _ in range(2):
        files = _add_files(flights, f"{folder}/in")
        jobs = {form: _stream_config(f"{folder}/in", f"{folder}/{form}", files=files) for form in ("bronze", "state", "stored")}
        many(bronze_stream(spark, *jobs["bronze"], run_date=RUN_DATE))
        many(silver_stream(spark, *jobs["state"]))
        many(silver_stream(spark, *jobs["stored"], stored=True))
    for form, job in jobs.items():
        rows = read_counts(spark, job[1]["datasetOuputPath"])
        counts.append(rows.agg(F.lit(form).alias("form"), F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out")))
    return counts[0].union(counts[1]).union(counts[2])


def q_silver_stream_bounded(spark, sf_dir):
    folder = scratch_dir(spark, "silver-bounded")
    path = landed_by_year(spark, sf_dir, "flights")
    job = _stream_config(path, folder, file_cap=1, files=_files(spark, path))
    many(silver_stream(spark, *job, delay="1 day"))
    return read_silver(spark, f"{folder}/table").select(*FLIGHT_KEY)


def q_silver_stream_stored(spark, sf_dir):
    """Two deliveries of the same flights; the last micro-batch of each is run again."""
    folder = scratch_dir(spark, "silver-stored")
    flights = read_batch(spark, landed(spark, sf_dir, "flights"))
    for _ in range(2):
        files = _add_files(flights, f"{folder}/in")
        job = _stream_config(f"{folder}/in", folder, files=files)
        many(silver_stream(spark, *job, stored=True))
        _undo_last_commit(spark, f"{folder}/checkpoint")
        many(silver_stream(spark, *job, stored=True), 1)
        compact_silver(spark, f"{folder}/table", remove=True)
    return read_silver(spark, f"{folder}/table").select(*FLIGHT_KEY)


def _undo_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Let a stream take its last micro-batch for unfinished."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().isdigit()]
    files.delete(max(paths, key=lambda p: int(p.getName())), False)


def q_silver_stream_clean(spark, sf_dir):
    folder = scratch_dir(spark, "silver-stream-clean")
    many(silver_stream(spark, *_stream_config(landed(spark, sf_dir, "unique"), folder), clean=True))
    return read_batch(spark, f"{folder}/table")


def q_gold_stream_append(spark, sf_dir):
    """Partial sums of one file at a time, every file with flights of all dates."""
    folder = scratch_dir(spark, "gold-append")
    many(gold_stream(spark, *_stream_config(landed(spark, sf_dir, "unique"), folder, file_cap=1)), FILES)
    return read_totals(spark, f"{folder}/table")


def q_gold_stream_compacted(spark, sf_dir):
    """Partial sums and changes, folded half-way and at the end, with what was folded removed."""
    folder = scratch_dir(spark, "gold-compacted")
    flights = read_batch(spark, landed(spark, sf_dir, "unique"))
    jobs = [_stream_config(f"{folder}/in", f"{folder}/{mode}", mode) for mode in ("append", "update")]
    for part in ("CRSDepTime < 1200", "CRSDepTime >= 1200"):
        _add_files(flights.where(part), f"{folder}/in")
        for job in jobs:
            many(gold_stream(spark, *job))
        compact_totals(spark, f"{folder}/append/table", remove=True)
        compact_changes(spark, f"{folder}/update/table", remove=True)
    totals = read_totals(spark, f"{folder}/append/table").withColumn("form", F.lit("append"))
    return totals.unionByName(read_changes(spark, f"{folder}/update/table").withColumn("form", F.lit("update")))


def q_gold_stream_snapshot(spark, sf_dir):
    folder = scratch_dir(spark, "gold-snapshot")
    many(gold_stream(spark, *_stream_config(landed(spark, sf_dir, "unique"), folder, "complete")))
    return read_snapshot(spark, f"{folder}/table")


def q_gold_stream_changes(spark, sf_dir):
    folder = scratch_dir(spark, "gold-changes")
    many(gold_stream(spark, *_stream_config(landed(spark, sf_dir, "unique"), folder, "update")))
    return read_changes(spark, f"{folder}/table")


def q_gold_stream_append_partitioned(spark, sf_dir):
    """Both stored forms under partition columns, a file at a time, folded half-way."""
    folder = scratch_dir(spark, "gold-partitioned")
    flights = read_batch(spark, landed(spark, sf_dir, "unique"))
    how = {"file_cap": 1, "partitionBy": ["OriginCityName"]}
    jobs = [_stream_config(f"{folder}/in", f"{folder}/{mode}", mode, **how) for mode in ("append", "update")]
    for part in ("CRSDepTime < 1200", "CRSDepTime >= 1200"):
        write_batch(flights.where(part).repartition(BATCHES), f"{folder}/in", mode="append")
        for job in jobs:
            many(gold_stream(spark, *job))
        if part == "CRSDepTime < 1200":
            compact_totals(spark, f"{folder}/append/table", remove=True)
            compact_changes(spark, f"{folder}/update/table")
    totals = read_totals(spark, f"{folder}/append/table").withColumn("form", F.lit("append"))
    return totals.unionByName(read_changes(spark, f"{folder}/update/table").withColumn("form", F.lit("update")))


def q_gold_stream_event_time(spark, sf_dir):
    folder, path = scratch_dir(spark, "gold-event-time"), landed_by_year(spark, sf_dir, "unique")
    job = _stream_config(path, folder, file_cap=1, files=_files(spark, path), partitionBy=["OriginCityName"])
    many(gold_stream(spark, *job, delay="1 day", by_event_time=True))
    return read_days(spark, f"{folder}/table")


def _out_of_order(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Days by event time of flights whose later half comes first; the path of the table."""
    flights = read_batch(spark, landed(spark, sf_dir, "unique"))
    (median,) = flights.agg(F.median(F.unix_date("FlightDate"))).first()
    job = _stream_config(f"{folder}/in", folder, partitionBy=["OriginCityName"])
    for later in (True, False):
        _add_files(flights.where((F.unix_date("FlightDate") >= median) == later), f"{folder}/in")
        many(gold_stream(spark, *job, delay="1 day", by_event_time=True))
    return f"{folder}/table"


def q_gold_stream_late(spark, sf_dir):
    """Late rows folded into the days they belong to."""
    return read_days(spark, _out_of_order(spark, sf_dir, scratch_dir(spark, "gold-late")), with_late=True)


def q_gold_stream_late_counts(spark, sf_dir):
    """Every flight is either in the partial sums or among the late rows."""
    table = _out_of_order(spark, sf_dir, scratch_dir(spark, "gold-late-counts"))
    timely = read_totals(spark, table).agg(F.sum("flights_count").alias("timely"))
    late = read_late(spark, table).agg(F.count("*").alias("late"))
    return timely.crossJoin(late).select((F.col("timely") + F.col("late")).alias("flights"), (F.col("late") > 0).alias("some_late"))


def q_gold_stream_arrival(spark, sf_dir):
    """Partial sums by arrival time; at the end of the run the watermark has emptied the state."""
    folder = scratch_dir(spark, "gold-arrival")
    job = _stream_config(landed(spark, sf_dir, "unique"), folder, partitionBy=["OriginCityName"])
    query = many(gold_stream(spark, *job, by_arrival=True))
    if left := sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]):
        raise AssertionError(f"{left} groups are left in the state")
    return read_arrivals(spark, f"{folder}/table", EVENT_TIME_COLUMN)


def q_layers_stream(spark, sf_dir):
    """Three streaming jobs in a row; which copy survives is open, so counts only."""
    folder = scratch_dir(spark, "layers-stream")


    def job(source: str, layer: str) -> tuple[dict, dict]:
        return _stream_config(source, f"{folder}/{layer}", files=_files(spark, source))

    many(bronze_stream(spark, *job(landed(spark, sf_dir, "flights"), "bronze"), run_date=RUN_DATE))
    many(silver_stream(spark, *job(f"{folder}/bronze/table", "silver")))
    many(gold_stream(spark, *job(f"{folder}/silver/table", "gold")))
    return read_totals(spark, f"{folder}/gold/table").select(*DAILY_ROUTE_KEY, "flights_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stamp_ingestion": q_stamp_ingestion,
    "stamp_arrival_time": q_stamp_arrival_time,
    "stamp_today": q_stamp_today,
    "ignore_missing_files": q_ignore_missing_files,
    "conform": q_conform,
    "conform_null_on_error": q_conform_null_on_error,
    "fill_nulls": q_fill_nulls,
    "clamp_min": q_clamp_min,
    "delay_flag": q_delay_flag,
    "rescue_columns": q_rescue_columns,
    "scalar_expressions": q_scalar_expressions,
    "aggregate_functions": q_aggregate_functions,
    "dedup": _unique,
    "dedup_any_row": q_dedup_any_row,
    "silver_transform": _silver,
    "gold_daily_route": q_gold_daily_route,
    "gold_monthly_carrier": q_gold_monthly_carrier,
    "gold_route_performance": q_gold_route_performance,
    "profile_counts": q_profile_counts,
    "dated_path_roundtrip": q_dated_path_roundtrip,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "partition_value_kept": q_partition_value_kept,
    "bronze_batch": q_bronze_batch,
    "silver_batch": q_silver_batch,
    "gold_batch_daily_route": _gold_job("daily_route"),
    "gold_batch_monthly_carrier": _gold_job("monthly_carrier"),
    "gold_batch_route_performance": _gold_job("route_performance"),
    "rerun_of_one_date": q_rerun_of_one_date,
    "versioned_layers": q_versioned_layers,
    "bronze_batch_broken_lines": q_bronze_batch_broken_lines,
    "bronze_stream_broken_lines": _broken_lines_stream(by_file_schema=False),
    "bronze_stream_broken_lines_by_file": _broken_lines_stream(by_file_schema=True),
    "bronze_stream": q_bronze_stream,
    "bronze_stream_backfill": q_bronze_stream_backfill,
    "bronze_stream_archived": q_bronze_stream_archived,
    "bronze_stream_drift": q_bronze_stream_drift,
    "bronze_stream_rescued": q_bronze_stream_rescued,
    "silver_stream": q_silver_stream,
    "silver_stream_bounded": q_silver_stream_bounded,
    "stream_counts": q_stream_counts,
    "silver_stream_stored": q_silver_stream_stored,
    "silver_stream_clean": q_silver_stream_clean,
    "gold_stream_append": q_gold_stream_append,
    "gold_stream_compacted": q_gold_stream_compacted,
    "gold_stream_snapshot": q_gold_stream_snapshot,
    "gold_stream_changes": q_gold_stream_changes,
    "gold_stream_append_partitioned": q_gold_stream_append_partitioned,
    "gold_stream_event_time": q_gold_stream_event_time,
    "gold_stream_late": q_gold_stream_late,
    "gold_stream_late_counts": q_gold_stream_late_counts,
    "gold_stream_arrival": q_gold_stream_arrival,
    "layers_stream": q_layers_stream,
}

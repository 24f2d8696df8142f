"""Silver kept as a table that is its own memory: no state store.

A micro-batch is freed of copies of its own and then of flights that the table holds. The table is asked as
little as possible: only folders whose flight dates meet those of the micro-batch, only those dates in them,
and only for rows that the folders' Bloom filters don't rule out. The micro-batch's own folder doesn't count
when it is run again, so it finds the same rows.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.functions import column, flight_day_instant
from delayworks.operators.key_filter import FILTER_BITS, FILTER_SCHEMA, key_filter, maybe_known, united
from delayworks.plans.silver import clean_flights
from delayworks.schema import FLIGHT_KEY
from delayworks.sinks.batches import (
    BATCH_COLUMN,
    Folder,
    Manifest,
    commit_folder,
    commit_notes,
    compact,
    each_batch,
    manifest,
    read_folders,
    read_live,
    write_folder,
)
from delayworks.sinks.commits import removed
from delayworks.sinks.files import write_batch
from delayworks.streaming.late import split_late

_KEY, _KNOWN, _MAYBE = "__key", "__known_key", "__maybe_known"
_DATES = "dates"
_FILTER = "filter-"


def _span(date: Column) -> list[Column]:
    return [
        F.min(F.unix_date(date)).alias("low"),
        F.max(F.unix_date(date)).alias("high"),
        F.count_if(date.isNull()).alias("nulls"),
    ]


def _meets(span: dict, other: dict) -> bool:
    """Whether two micro-batches can have a date in common; rows without a date meet each other."""
    both = None not in (span["low"], other["low"])
    return bool(span["nulls"] and other["nulls"]) or (both and span["low"] <= other["high"] and other["low"] <= span["high"])


def _within(date: Column, span: dict) -> Column:
    inside = F.lit(False) if span["low"] is None else date.between(
        F.date_from_unix_date(F.lit(span["low"])), F.date_from_unix_date(F.lit(span["high"]))
    )
    return inside | date.isNull() if span["nulls"] else inside


def write_new_flights(
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    event_date: str = "FlightDate",
    clean: bool = False,
    delay: str | None = None,
    keys: Sequence[str] = FLIGHT_KEY,
    filter_bits: int = FILTER_BITS,
    counts: list[tuple[int, int, int]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the rows of a micro-batch whose key the table doesn't hold yet.

    One row per key; NULL keys equal each other. With a ``delay``, rows behind the stored watermark over
    ``event_date`` go to the side table of late rows (see ``delayworks.streaming.late``). ``counts`` gets
    (batch_id, rows in, rows out), late rows in neither.
    """
    date, key = column(event_date).cast("date"), F.struct(*(column(k) for k in keys))

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        spark, note = batch.sparkSession, dict
        if delay is not None:
            event = flight_day_instant(event_date)
            batch, note = split_late(batch, batch_id, path, run, event, event, delay, fmt)
        held, span = manifest(spark, run), batch.agg(*_span(date), F.count(F.lit(1)).alias("rows")).first().asDict()
        rows_in = span.pop("rows")
        spans = held.notes.get(_DATES, {})
        met = [f for f in held.folders if f.number != batch_id and _meets(span, spans[f.name])]
        rows = _one_per_key(batch, keys)
        if met:
            rows = _unknown(rows, run, met, held, _within(date, span), key, filter_bits)
        rows = rows.select(*_unpacked(batch, keys))
        rows = clean_flights(rows) if clean else rows
        folder = write_folder(rows, run, batch_id, fmt, partition_by)
        stored = read_folders(spark, run, [folder], rows.schema, fmt)
        own = stored.agg(*_span(date), F.count(F.lit(1)).alias("rows")).first().asDict()
        rows_out = own.pop("rows")
        if rows_out:
            write_batch(key_filter(stored, key, filter_bits), f"{run}/{_FILTER}{folder.name}")
            commit_folder(rows, run, folder, fmt, lambda notes: _dated(note(notes), folder, own))
        else:
            removed(spark, f"{run}/{folder.name}")
            if delay is not None:
                commit_notes(spark, run, note)
        if counts is not None:
            counts.append((batch_id, rows_in, rows_out))

    return each_batch(path, checkpoint, write)


def _dated(notes: dict, folder: Folder, span: dict) -> dict:
    return notes | {_DATES: notes.get(_DATES, {}) | {folder.name: span}}


def _key_columns(batch: DataFrame, keys: Sequence[str]) -> dict[str, str]:
    """The key's name of each column of the frame that is part of the key."""
    exact = batch.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    names = {k if exact else k.lower(): k for k in keys}
    return {c: names[n] for c in batch.columns if (n := c if exact else c.lower()) in names}


def _one_per_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the key in a struct and its columns only there.

    In the struct NULLs equal each other, and join and dedup share one shuffle. Strings of the key aren't among the
    values that dedup carries along then, so it is a hash aggregate and sorts nothing.
    """
    key = F.struct(*(column(k) for k in keys)).alias(_KEY)
    rest = [column(c) for c in batch.columns if c not in _key_columns(batch, keys)]
    return batch.select(key, *rest).dropDuplicates([_KEY])


def _unpacked(batch: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The frame's columns in their order, those of the key taken from the struct."""
    packed = _key_columns(batch, keys)
    return [F.col(_KEY).getField(packed[c]).alias(c) if c in packed else column(c) for c in batch.columns]


def _unknown(
    rows: DataFrame, run: str, met: Sequence[Folder], held: Manifest, dates: Column, key: Column, filter_bits: int
) -> DataFrame:
    """The rows whose key is in none of the folders. The rows are computed once, and stay where dedup has put them."""
    spark = rows.sparkSession
    filters = spark.read.schema(FILTER_SCHEMA).parquet(*(f"{run}/{_FILTER}{f.name}" for f in met))
    marked = maybe_known(rows, F.col(_KEY), united(filters), _MAYBE, filter_bits)
    stored = read_folders(spark, run, met, held.schema, held.fmt).where(dates).select(key.alias(_KNOWN))
    known = F.col(_MAYBE) & (F.col(_KEY) == F.col(_KNOWN))
    return marked.join(stored, known, "left_anti")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All flights of a stored silver table."""
    return read_live(spark, path).drop(BATCH_COLUMN)


def compact_silver(spark: SparkSession, path: str, remove: bool = False, partition_by: Sequence[str] | None = None) -> None:
    """Put the flights of all micro-batches into one folder, with one filter."""

    def beside(run: str, held: Manifest, base: Folder) -> dict:
        filters = spark.read.schema(FILTER_SCHEMA).parquet(*(f"{run}/{_FILTER}{f.name}" for f in held.folders))
        write_batch(united(filters), f"{run}/{_FILTER}{base.name}")
        spans = [held.notes[_DATES][f.name] for f in held.folders]
        low = min((s["low"] for s in spans if s["low"] is not None), default=None)
        high = max((s["high"] for s in spans if s["high"] is not None), default=None)
        return held.notes | {_DATES: {base.name: {"low": low, "high": high, "nulls": sum(s["nulls"] for s in spans)}}}

    compact(spark, path, lambda rows: rows, partition_by=partition_by, remove=remove, beside=beside)

"""Rows behind a watermark, kept instead of dropped.

The watermark, the latest event time of former micro-batches less a delay, is stored with each
micro-batch. Rows whose window it has passed, and rows without an event time, are late: they go to a side table
below ``<path>/late`` before the timely rows are committed, so no row that the checkpoint has passed is stored
nowhere. A micro-batch that is run again is split by the same watermark.
"""

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayworks.sinks.batches import compact, manifest, read_live, store

LATE = "late"
_WATERMARKS = "watermarks"
#: Watermarks of so many micro-batches stay in the manifest; the last one may be run again.
_KEPT = 5


def watermark(notes: dict, before: int | None = None) -> int | None:
    """The stored watermark in microseconds, as it was before a micro-batch; None before the first."""
    held = (v for k, v in notes.get(_WATERMARKS, {}).items() if before is None or int(k) < before)
    return max((v for v in held if v is not None), default=None)


def noted(notes: dict, batch_id: int, value: int | None) -> dict:
    """The notes with the watermark after a micro-batch; it never goes back."""
    held = {k: v for k, v in notes.get(_WATERMARKS, {}).items() if int(k) != batch_id}
    former = watermark({_WATERMARKS: held}, batch_id)
    held[str(batch_id)] = max((v for v in (former, value) if v is not None), default=None)
    last = sorted(held, key=int)[-_KEPT:]
    return notes | {_WATERMARKS: {k: held[k] for k in last}}


def instant(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def split_late(
    batch: DataFrame, batch_id: int, path: str, run: str, event: Column, ends: Column, delay: str, fmt: str = "parquet"
) -> tuple[DataFrame, Callable[[dict], dict]]:
    """The timely rows of a micro-batch, and what to note when they are committed.

    The late ones are stored here. ``ends`` is the end of the row's window, or its event time if it has none.
    """
    spark = batch.sparkSession
    mark = watermark(manifest(spark, run).notes, batch_id)
    late = event.isNull() if mark is None else event.isNull() | (ends <= instant(mark))
    late = F.coalesce(late, F.lit(True))
    latest = F.unix_micros(F.max(event - F.expr(f"INTERVAL '{delay}'")))
    seen = batch.agg(latest.alias("latest"), F.count_if(late).alias("late")).first()
    if seen["late"]:
        store(batch.where(late), run.replace(path, f"{path}/{LATE}", 1), batch_id, fmt)
    return batch.where(~late), partial(noted, batch_id=batch_id, value=seen["latest"])


def read_late(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The late rows of a stream, as they came."""
    return read_live(spark, f"{path}/{LATE}", schema)


def compact_late(spark: SparkSession, path: str, remove: bool = False, partition_by: Sequence[str] | None = None) -> None:
    """Put the late rows of all micro-batches into one folder."""
    compact(spark, f"{path}/{LATE}", lambda rows: rows, partition_by=partition_by, remove=remove)

"""Rows in and out of a stream's micro-batches, counted by the stream itself."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delayworks.sinks.commits import listed

COUNTS = "_counts"
_SCHEMA = "batch_id long, rows_in long, rows_out long"
_IN, _OUT = "delayworks_rows_in", "delayworks_rows_out"


def counted(df: DataFrame, out: bool = False) -> DataFrame:
    """The streaming frame, its rows counted in the progress of each micro-batch; no further pass."""
    return df.observe(_OUT if out else _IN, F.count(F.lit(1)).alias("rows"))


def counts_of(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch_id, rows in, rows out) of the micro-batches of the query's run that took or gave rows.

    Frames must have passed ``counted`` on both sides, and the sink must be a plain one, as ``foreachBatch`` may
    compute a micro-batch several times.
    """
    rows = []
    for progress in query.recentProgress:
        seen = progress["observedMetrics"]
        counts = [seen[name]["rows"] for name in (_IN, _OUT) if name in seen]
        if len(counts) == 2 and any(counts):
            rows.append((progress["batchId"], *counts))
    return rows


def store_counts(spark: SparkSession, path: str, rows: list[tuple[int, int, int]]) -> None:
    """Add the counts of some micro-batches to those below a table's path, one small file."""
    if rows:
        spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{COUNTS}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, rows_in, rows_out) of a stream's micro-batches.

    A micro-batch that was run again was counted again, with the same numbers, and stands here once. One whose run was
    cut off between its commit and the end of the run is missing.
    """
    if COUNTS not in listed(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    stored = spark.read.schema(_SCHEMA).parquet(f"{path}/{COUNTS}")
    return stored.groupBy("batch_id").agg(F.max("rows_in").alias("rows_in"), F.max("rows_out").alias("rows_out"))

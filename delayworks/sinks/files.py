"""Writers over path-based formats."""

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_STATE_ON_DISK = {
    _STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else every store takes some megabytes of the executors' disks before it holds anything
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Progress of so many micro-batches is kept, so that no dropped row of a run goes unseen.
_PROGRESS = {"spark.sql.streaming.numRecentProgressUpdates": "100000"}
_WRITER = "__writer_of_value"


def write_batch(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    replace_partitions: bool = False,
) -> None:
    """Write a frame, replacing the whole path by default.

    ``replace_partitions`` replaces only the partitions that the frame has rows of, so a rerun for one date
    leaves the files of the others as they are.

    A partitioned write first brings the rows of a partition value together, to
    avoid one small file per task and value. It does so with a rebalance, which
    AQE splits again by size: a value holding much of the data gets many tasks.
    """
    if replace_partitions and (not partition_by or mode != "overwrite"):
        raise ValueError("only a partitioned overwrite can replace partitions")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    given = {**(options or {}), "partitionOverwriteMode": "dynamic" if replace_partitions else "static"}
    writer = df.write.format(fmt).mode(mode).options(**given)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(df: DataFrame, path: str, **how) -> int:
    """Write a frame as ``write_batch`` does; the number of rows, counted by the write itself."""
    rows = Observation()
    write_batch(df.observe(rows, F.count(F.lit(1)).alias("rows")), path, **how)
    return rows.get["rows"]


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    output_mode: str = "append",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    files_per_value: int | None = None,
) -> DataStreamWriter:
    """A checkpointed streaming file sink, not yet started.

    ``files_per_value`` bounds the files a micro-batch writes per partition
    value, at the price of a shuffle; streams have no adaptive rebalance.
    """
    if partition_by and files_per_value:
        writer_no = F.spark_partition_id() % files_per_value
        spread = df.withColumn(_WRITER, writer_no).repartition(*partition_by, _WRITER)
        df = spread.drop(_WRITER)
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .options(**(options or {}))
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_available(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Process all input that is new to the checkpoint, then stop. Errors are raised."""
    with _state_on_disk(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark in the query's run, and were left out."""
    operators = (o for p in query.recentProgress for o in p["stateOperators"])
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


@contextmanager
def _state_on_disk(spark: SparkSession):
    """Start queries on the RocksDB state store unless the session chose a store.

    Keys of a stream without a watermark pile up for ever; the default store
    holds them on the executors' heaps. With a changelog, a micro-batch uploads
    what changed and not the whole store. A restart keeps its checkpoint's store.
    """
    chosen = spark.conf.get(_STATE_STORE, None) is not None
    wanted = _PROGRESS | ({} if chosen else _STATE_ON_DISK)
    ours = {k: v for k, v in wanted.items() if spark.conf.get(k, None) is None}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)

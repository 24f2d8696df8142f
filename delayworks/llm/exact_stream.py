"""Exact duplicates on a stream of files; native functions only.

New files are taken in micro-batches. The keyed state, in Spark's disk-backed store and without expiry,
has per digest the first arrival (stable identifier and content locator: file and row in it), the row with the
largest id, and the number of rows. The texts themselves stay where they are. A digest with
several rows is a hit, and hits are compared byte by byte: within a micro-batch the least and the greatest
text of a digest, one of each per task, and with the text that the first arrival's locator names where that came
in an earlier run. Texts that differ under one digest are told apart by the texts from then on.

A folder holds it all: ``state`` (checkpoint), ``rows`` and ``contents`` by micro-batch, ``hits``
and ``variants`` by run. A run that was cut off is repeated from its checkpoints.
"""

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayworks.llm.tables import stored
from delayworks.sinks import run_available
from delayworks.sources import read_stream

FILES_PER_BATCH = 1000
#: Bits of the filter of hits: 1,024 bitmaps of 4 kB each, so 4 MB at most are broadcast.
FILTER_BITS = 1 << 25
_VARIANT = "digest binary, path string, row long, keeper struct<id: long, path: string, row: long>, n long"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(rows: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """(digest, place, text) of rows read from files; NULL counts as the empty text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    place = F.struct(
        F.col(id_col).cast("long").alias("id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"),
    )
    return rows.select(digest(text).alias("digest"), place.alias("place"), text.alias("text"))


def _finished(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the runs that came to their end, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/variants")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/variants/batch=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found or [])


def state(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, keeper, arrival, first, n) of all digests, read from the state store."""
    kept = spark.read.format("statestore").load(f"{folder}/state")
    return kept.select(
        F.col("key.digest").alias("digest"),
        F.col("value.max").alias("keeper"),
        F.col("value.min.arrival").alias("arrival"),
        F.col("value.min.place").alias("first"),
        F.col("value.count").alias("n"),
    )


def maybe_among(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows whose digest may be among those given; none of these is lost."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS)) + 1
    bucket, position = F.bitmap_bucket_number(bit), F.bitmap_bit_position(bit)
    maps = digests.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.expr("position div 8 + 1"), F.lit(1))), 16, 10).cast("long")
    marked = rows.withColumns({"bucket": bucket, "position": position}).join(F.broadcast(maps), "bucket")
    return marked.where(F.getbit(byte, F.col("position") % 8) == 1).select(rows.columns)


def _texts_at(spark: SparkSession, places: DataFrame, schema: StructType, text_col: str) -> DataFrame:
    """The texts at places (.., path, row); at most one path per source file comes to the driver."""
    files = [unquote(r["path"]) for r in places.select("path").distinct().collect()]
    if not files:
        return places.withColumn("text", F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = spark.read.schema(schema).parquet(*files)
    found = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), text.alias("text"))
    return found.join(places, ["path", "row"])


def _told_apart(spark: SparkSession, folder: str, digests: DataFrame, schema: StructType, text_col: str) -> DataFrame:
    """For digests of several texts, per row the keeper and the number of the rows with its very text."""
    rows = spark.read.parquet(f"{folder}/rows").join(digests, "digest", "left_semi")
    texts = _texts_at(spark, rows.select("digest", "id", "path", "row"), schema, text_col)
    texts = texts.withColumn("place", F.struct("id", "path", "row"))
    groups = texts.groupBy("digest", "text").agg(F.max("place").alias("keeper"), F.count(F.lit(1)).alias("n"))
    return texts.join(groups, ["digest", "text"]).select("digest", "path", "row", "keeper", "n")


def take(
    spark: SparkSession,
    path: str,
    folder: str,
    schema: StructType,
    id_col: str = "doc_id",
    text_col: str = "text",
    files_per_batch: int = FILES_PER_BATCH,
    digest: Callable[[Column], Column] = sha256,
) -> None:
    """Take the Parquet files of ``path`` that are new to ``folder``, and check their hits.

    Files must stay as long as their rows count, as locators point into them. NULL texts count as
    empty. Rows may repeat and ids may be NULL: every row is one of its group. An empty table leaves nothing.
    """
    run = max(_finished(spark, folder), default=-1) + 1  # the number of the run's first micro-batch

    def stream() -> DataFrame:
        return _located(read_stream(spark, path, schema, max_files_per_trigger=files_per_batch), digest, id_col, text_col)

    arrived = F.struct(F.lit(run).cast("long").alias("arrival"), "place")
    groups = stream().groupBy("digest").agg(F.max("place"), F.min(arrived), F.count(F.lit(1)))
    run_available(
        spark,
        groups.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{folder}/state"),
    )

    numbers: list[int] = []
    hits = f"{folder}/hits/run={run}"

    def settle(batch: DataFrame, number: int) -> None:
        if not numbers:
            state(spark, folder).where("n > 1").write.mode("overwrite").parquet(hits)
        batch.select("digest", "place.*").write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        texts = maybe_among(batch.select("digest", "text"), batch.sparkSession.read.parquet(hits).select("digest"))
        texts = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
        texts.write.mode("overwrite").parquet(f"{folder}/contents/batch={number}")
        numbers.append(number)

    run_available(
        spark,
        stream().writeStream.option("checkpointLocation", f"{folder}/taken").foreachBatch(settle),
    )
    if not numbers:
        return
    contents = spark.read.parquet(f"{folder}/contents").where(F.col("batch") >= run).select("digest", "low", "high")
    earlier = spark.read.parquet(hits).where(F.col("arrival") < run).select("digest", "first.path", "first.row")
    earlier = stored(earlier.join(contents, "digest", "left_semi"), "earlier")
    first = _texts_at(spark, earlier, schema, text_col)
    first = first.select("digest", F.col("text").alias("low"), F.col("text").alias("high"))
    spans = contents.unionByName(first).groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    before = _variants(spark, folder)
    differing = spans.where("low <> high").select("digest").unionByName(before.select("digest"))
    differing = stored(differing.distinct(), "differing")
    apart = before if differing.isEmpty() else _told_apart(spark, folder, differing, schema, text_col)
    apart.write.mode("overwrite").parquet(f"{folder}/variants/batch={max(numbers)}")


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    finished = _finished(spark, folder)
    if not finished:
        return spark.createDataFrame([], _VARIANT)
    return spark.read.schema(_VARIANT).parquet(f"{folder}/variants/batch={finished[-1]}")


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per row taken: (id, keep_id, group_size, kept, digest).

    Of equal texts the row with the largest id stays; of rows with that id the last one by file and place, so
    exactly one row of a group stays. NULL ids are smaller than all others.
    """
    if not _finished(spark, folder):
        return spark.createDataFrame([], "id long, keep_id long, group_size long, kept boolean, digest binary")
    rows = spark.read.parquet(f"{folder}/rows").select("digest", "id", "path", "row")
    groups = rows.join(stored(state(spark, folder).select("digest", "keeper", "n"), "groups"), "digest")
    apart = _variants(spark, folder)
    if not apart.isEmpty():
        apart = apart.select("path", "row", F.col("keeper").alias("own_keeper"), F.col("n").alias("own_n"))
        groups = groups.join(apart, ["path", "row"], "left").withColumns(
            {"keeper": F.coalesce("own_keeper", "keeper"), "n": F.coalesce("own_n", "n")}
        )
    kept = (F.col("path") == F.col("keeper.path")) & (F.col("row") == F.col("keeper.row"))
    return groups.select("id", F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), "digest")

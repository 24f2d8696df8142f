"""Readers over path-based formats."""

import time
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: the part of a path that stands for the run's date.
DATE_PLACEHOLDER = "YYYY_MM_DD"

# Formats whose streams need a declared schema and take files by age.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "xml", "text", "binaryFile")
ANY_AGE = "36500d"

# Formats of text records, and Spark's name for the column that takes those it can't parse.
RECORD_FORMATS = ("json", "csv", "xml")
CORRUPT_RECORD = "_corrupt_record"


def dated_path(template: str, run_date: date) -> str:
    """Put the run's date in place of every ``YYYY_MM_DD`` of a path."""
    return template.replace(DATE_PLACEHOLDER, run_date.strftime("%Y_%m_%d"))


def read_batch(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    ignore_missing_files: bool = False,
    corrupt_records: bool = False,
) -> DataFrame:
    """Everything under a path or several; the schema comes from the files unless given.

    Values of partition folders are guessed ("007" reads as 7) unless the schema declares them. With
    ``corrupt_records``, text records that can't be parsed stay as rows, whole in ``CORRUPT_RECORD``.
    """
    paths = path if isinstance(path, str) else list(path)
    given = _with_missing(options, ignore_missing_files)
    if corrupt_records and fmt in RECORD_FORMATS:
        given |= _PERMISSIVE
        inferred = schema if schema is not None else spark.read.format(fmt).options(**given).load(paths).schema
        schema = with_corrupt_record(inferred)
    reader = spark.read.format(fmt).options(**given)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)


_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}


def with_corrupt_record(schema: StructType | str) -> StructType:
    """The schema with the column of records that can't be parsed, which inference adds only if it meets one."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rest = [f for f in fields if f.name != CORRUPT_RECORD]
    return StructType([*rest, StructField(CORRUPT_RECORD, StringType())])


def infer_stream_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    merge: bool = False,
) -> StructType:
    """Schema of the files present now, to be declared on a stream over the same path.

    One file stands for all, or, with ``merge``, all files' schemas are united in one distributed
    job, so a column that only some files have is not lost. Files that give one column
    incompatible types are refused then.
    """
    united = {"mergeSchema": "true"} if merge and fmt in ("parquet", "orc", "avro") else {}
    return read_batch(spark, path, fmt, options={**united, **(options or {})}).schema


def schema_groups(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> list[list[str]]:
    """Files in groups whose schemas unite. Files that don't unite are halved until they do; groups of
    one schema are put together."""
    return [files for _, files in united_schemas(spark, paths, fmt, options)]


def united_schemas(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> list[tuple[StructType, list[str]]]:
    """The groups of ``schema_groups``, each with its schema, so that a reader needn't infer it again: for text
    records that is a pass over all of them."""
    given = {**(options or {}), "mergeSchema": "true"}
    todo, groups = [sorted(paths)], {}
    while todo:
        files = todo.pop()
        try:
            schema = read_batch(spark, files, fmt, options=given, corrupt_records=True).schema
        except Exception as refused:
            if len(files) == 1 or "CANNOT_MERGE" not in str(refused):
                raise
            todo += [files[: len(files) // 2], files[len(files) // 2 :]]
            continue
        groups.setdefault(schema.json(), (schema, []))[1].extend(files)
    return list(groups.values())


def read_new_paths(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A stream of the paths of new files, whatever their names but those that Spark's readers skip; their
    content is not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return read_stream(spark, path, schema, "binaryFile", options, max_files_per_trigger).select("path")


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = False,
    corrupt_records: bool = False,
) -> DataFrame:
    """New files of a folder, each exactly once per checkpoint, however old their timestamps.

    Spark by default skips files a week older than the newest one that it has seen. Here it skips
    none unless ``options`` set ``maxFileAge``; the checkpoint then remembers every path, and the
    driver holds them. Pass no schema only for formats that bring their own; see
    ``infer_stream_schema`` for the others. ``corrupt_records`` is as in ``read_batch``.
    """
    given = _with_missing(options, ignore_missing_files)
    if corrupt_records and schema is not None and fmt in RECORD_FORMATS:
        given, schema = given | _PERMISSIVE, with_corrupt_record(schema)
    if "maxfileage" not in {name.lower() for name in given} and fmt in FILE_FORMATS:
        given["maxFileAge"] = ANY_AGE
    reader = spark.readStream.format(fmt).options(**given)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def renew_old_files(spark: SparkSession, path: str, checkpoint: str, age_seconds: float) -> int:
    """Give files that a stream hasn't taken, and that are older than the age, the present as their time.

    A stream that forgets the paths it took longer ago than ``maxFileAge`` skips files as old as that. Its own log
    tells what it took; files it took and hasn't archived yet stay as they are. The number of files renewed.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    log = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/sources/0")
    plain = lambda p: F.regexp_replace(F.coalesce(F.try_url_decode(p), p), "^([A-Za-z0-9]+):/+", "$1:/")
    over = F.col("modificationTime") < F.timestamp_micros(F.lit(int((time.time() - age_seconds) * 1e6)))
    schema = "path string, modificationTime timestamp, length long, content binary"
    old = spark.read.format("binaryFile").schema(schema).load(path).where(over).select("path")
    if log.getFileSystem(conf).exists(log):
        lines = spark.read.text(f"{checkpoint}/sources/0/*")
        taken = lines.select(plain(F.get_json_object("value", "$.path")).alias("taken")).where("taken is not null")
        old = old.join(taken, plain(F.col("path")) == F.col("taken"), "left_anti")
    renewed = 0
    for row in old.toLocalIterator():
        file = jvm.org.apache.hadoop.fs.Path(row["path"])
        file.getFileSystem(conf).setTimes(file, int(time.time() * 1000), -1)
        renewed += 1
    return renewed


def _with_missing(options: Mapping[str, str] | None, ignore: bool) -> dict[str, str]:
    """A per-read setting, so that other reads of the session stay strict."""
    return {**(options or {}), **({"ignoreMissingFiles": "true"} if ignore else {})}

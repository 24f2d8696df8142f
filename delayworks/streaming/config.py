"""The two configuration dictionaries of a streaming job."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from delayworks.sinks import write_stream
from delayworks.sources import infer_stream_schema, read_stream, renew_old_files
from delayworks.sources.files import FILE_FORMATS

# Configuration keys, and the source options that open Spark
# knows by another name or provides in another way.
VENDOR_FORMAT = "cloudFiles"
VENDOR_PREFIX = "cloudFiles."
VENDOR_FILE_FORMAT = "cloudFiles.format"
VENDOR_RESCUE_COLUMN = "cloudFiles.rescuedDataColumn"
VENDOR_FILE_CAP = "cloudFiles.maxFilesPerTrigger"
VENDOR_INFER_TYPES = "cloudFiles.inferColumnTypes"
#: Vendor options about file discovery and schema tracking, which the file stream does by itself.
VENDOR_NOT_NEEDED = {
    "cloudFiles.schemaLocation",
    "cloudFiles.schemaEvolutionMode",
    "cloudFiles.includeExistingFiles",
    "cloudFiles.useNotifications",
}
MISSING_FILES = "ignoreMissingFiles"
ARCHIVE = "archivePath"
#: With an archive, a stream forgets paths this long after it took them.
ARCHIVED_AGE_DAYS = 7
_SELF_TYPED = ("parquet", "orc", "avro", "delta")


@dataclass(frozen=True)
class StreamInput:
    """Where a stream comes from."""

    path: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    max_files_per_trigger: int | None = None
    rescue_column: str | None = None
    ignore_missing_files: bool = False
    archive: str | None = None

    @classmethod
    def from_config(cls, config: Mapping) -> "StreamInput":
        """Read ``format``, ``datasetInputPath`` and ``autoloaderOptions``.

        Vendor options for the file format, the cap on files, the rescue column
        and inferred column types are honoured; those about discovery and schema
        tracking are not needed, as the schema is inferred once at the start; any
        other vendor option is refused. ``ignoreMissingFiles`` (off unless given)
        and other options are Spark's own. ``archivePath`` is where files go once a later micro-batch
        has followed the one that took them, below their own path; the source then holds what is new and the last
        micro-batch, and the driver remembers a week of paths, not all (see ``renew_old_files``).
        """
        given = config.get("autoloaderOptions", {})
        fmt = config.get("format", VENDOR_FORMAT)
        if fmt == VENDOR_FORMAT:
            fmt = given.get(VENDOR_FILE_FORMAT, "parquet")
        cap = given.get(VENDOR_FILE_CAP)
        known = {VENDOR_FILE_FORMAT, VENDOR_FILE_CAP, VENDOR_RESCUE_COLUMN, VENDOR_INFER_TYPES, *VENDOR_NOT_NEEDED}
        if unknown := sorted(k for k in given if k.startswith(VENDOR_PREFIX) and k not in known):
            raise ValueError(f"options without a counterpart: {unknown}")
        options = {k: v for k, v in given.items() if not k.startswith(VENDOR_PREFIX) and k not in (MISSING_FILES, ARCHIVE)}
        if ARCHIVE in given:
            options = {"maxFileAge": f"{ARCHIVED_AGE_DAYS}d", **options, "cleanSource": "archive", "sourceArchiveDir": given[ARCHIVE]}
        if fmt not in _SELF_TYPED and VENDOR_INFER_TYPES in given:
            options.setdefault("inferSchema", str(given[VENDOR_INFER_TYPES]).lower())
        return cls(
            path=config["datasetInputPath"],
            fmt=fmt,
            options=options,
            max_files_per_trigger=None if cap is None else int(cap),
            rescue_column=given.get(VENDOR_RESCUE_COLUMN),
            ignore_missing_files=str(given.get(MISSING_FILES, False)).lower() == "true",
            archive=given.get(ARCHIVE),
        )

    def prepare(self, spark: SparkSession, checkpoint: str) -> "StreamInput":
        """Before a run: with an archive, files that came with old times are made to be taken."""
        if self.archive:
            renew_old_files(spark, self.path, checkpoint, ARCHIVED_AGE_DAYS * 86_400 / 2)
        return self

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """The stream, with the schema of the present files unless one is given: of all of them
        where columns are rescued, as a column outside of the schema never reaches the stream. Text
        records that can't be parsed are rescued too."""
        if schema is None and self.fmt in FILE_FORMATS:
            schema = infer_stream_schema(
                spark, self.path, self.fmt, self.options, merge=self.rescue_column is not None
            )
        return read_stream(
            spark,
            self.path,
            schema,
            self.fmt,
            self.options,
            self.max_files_per_trigger,
            ignore_missing_files=self.ignore_missing_files,
            corrupt_records=self.rescue_column is not None,
        )


@dataclass(frozen=True)
class StreamOutput:
    """Where a stream goes."""

    path: str
    checkpoint: str
    fmt: str = "parquet"
    output_mode: str = "append"
    partition_by: tuple[str, ...] = ()
    files_per_value: int | None = None

    @classmethod
    def from_config(cls, config: Mapping) -> "StreamOutput":
        """Read ``datasetOuputPath`` (so spelled), ``checkpointPath``, ``format``,
        ``outputMode``, ``partitionBy`` and ``filesPerValue`` (see ``write_stream``)."""
        columns = config.get("partitionBy", ())
        return cls(
            path=config["datasetOuputPath"],
            checkpoint=config["checkpointPath"],
            fmt=config.get("format", "parquet"),
            output_mode=config.get("outputMode", "append"),
            partition_by=(columns,) if isinstance(columns, str) else tuple(columns),
            files_per_value=config.get("filesPerValue"),
        )

    def write(self, df: DataFrame) -> DataStreamWriter:
        """A file sink for the frame, not yet started."""
        return write_stream(
            df,
            self.path,
            self.checkpoint,
            self.fmt,
            self.output_mode,
            self.partition_by,
            files_per_value=self.files_per_value,
        )

"""Micro-batches stored in folders of their own, below ``<path>/run=<checkpoint>``.

A run is the life of a checkpoint, named by the time of its first start and its id, so a fresh
checkpoint on an old path begins a run of its own and readers take the newest run only. The run's
manifest (see ``delayworks.sinks.commits``) names the folders that count, with their partition columns, and the schema.
A folder counts from the commit that names it on: half-written ones never do, and a micro-batch
that is run again takes the place of its former folder. Readers list the runs and one manifest,
however many micro-batches there are. Folders can be folded into a base, which stands for all
numbers up to its own.
"""

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayworks.sinks.commits import commit, latest, listed, removed
from delayworks.sinks.files import write_batch

BATCH_COLUMN = "batch_id"
_FOLDER = "folder="


@dataclass(frozen=True)
class Folder:
    """A committed folder: ``kind`` is ``batch`` or ``base``."""

    kind: str
    number: int
    name: str
    partition_by: tuple[str, ...] = ()

    @classmethod
    def new(cls, kind: str, number: int, partition_by: Sequence[str]) -> "Folder":
        """A folder with a name that no other attempt has."""
        return cls(kind, number, f"{_FOLDER}{kind}-{number}-{uuid4().hex[:8]}", tuple(partition_by))


@dataclass(frozen=True)
class Manifest:
    """What a run holds: its folders in order, those that were replaced and may go, format and schema.

    ``notes`` is for jobs that keep something with each micro-batch.
    """

    fmt: str = "parquet"
    schema: StructType = field(default_factory=StructType)
    folders: tuple[Folder, ...] = ()
    dropped: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)

    @classmethod
    def of(cls, document: dict | None) -> "Manifest":
        if document is None:
            return cls()
        folders = tuple(Folder(**{**f, "partition_by": tuple(f["partition_by"])}) for f in document["folders"])
        schema = StructType.fromJson(document["schema"])
        return cls(document["fmt"], schema, folders, tuple(document["dropped"]), document["notes"])

    def document(self) -> dict:
        return {
            "fmt": self.fmt,
            "schema": json.loads(self.schema.json()),
            "folders": [asdict(f) for f in self.folders],
            "dropped": list(self.dropped),
            "notes": self.notes,
        }

    def holds(self, number: int) -> bool:
        """Whether a base stands for this micro-batch."""
        return any(f.kind == "base" and f.number >= number for f in self.folders)

    def with_batch(self, folder: Folder, schema: StructType, fmt: str) -> "Manifest":
        """With a micro-batch's folder, in place of a former one of its number."""
        if self.holds(folder.number):
            return replace(self, dropped=(*self.dropped, folder.name))
        former = [f for f in self.folders if f.number == folder.number]
        rest = [f for f in self.folders if f.number != folder.number]
        folders = tuple(sorted([*rest, folder], key=lambda f: f.number))
        return replace(self, fmt=fmt, schema=schema, folders=folders, dropped=(*self.dropped, *(f.name for f in former)))

    def without(self, gone: Sequence[Folder], base: Folder | None = None) -> "Manifest":
        """Without some folders, for which a base may stand."""
        names = [f.name for f in gone]
        rest = [f for f in self.folders if f.name not in names]
        return replace(self, folders=tuple([base, *rest] if base else rest), dropped=(*self.dropped, *names))


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a started checkpoint stands for, from its metadata file."""
    found = spark.read.text(f"{checkpoint}/metadata").select(
        F.get_json_object("value", "$.id").alias("id"), F.unix_millis("_metadata.file_modification_time").alias("started")
    )
    row = found.where("id is not null").first()
    return f"{row['started']:015d}-{row['id']}"


def current_run(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest run with a committed micro-batch."""
    runs = sorted((n for n in listed(spark, path) if n.startswith("run=")), reverse=True)
    return next((f"{path}/{r}" for r in runs if latest(spark, f"{path}/{r}")), None)


def manifest(spark: SparkSession, run: str) -> Manifest:
    return Manifest.of(latest(spark, run))


def write_batches(
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each micro-batch, transformed, with its number."""

    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        store(transform(batch), run, batch_id, fmt, partition_by)

    return each_batch(path, checkpoint, write)


def each_batch(path: str, checkpoint: str, write: Callable[[DataFrame, int, str], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that also gets the folder of its run. A micro-batch that a base
    stands for already, when it is run again after a compaction, is left out."""
    run: list[str] = []

    def of_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not run:
            run.append(f"{path}/run={run_name(spark, checkpoint)}")
        if not manifest(spark, run[0]).holds(batch_id):
            write(batch, batch_id, run[0])

    return of_batch


def store(
    df: DataFrame,
    run: str,
    batch_id: int,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    note: Callable[[dict], dict] = lambda notes: notes,
) -> None:
    """Write a micro-batch's rows to a folder of their own and commit it, with what ``note`` makes of the notes."""
    commit_folder(df, run, write_folder(df, run, batch_id, fmt, partition_by), fmt, note)


def _numbered(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))


def write_folder(df: DataFrame, run: str, batch_id: int, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Folder:
    """Write a micro-batch's rows with its number to a new folder, which counts once it is committed."""
    folder = Folder.new("batch", batch_id, partition_by)
    write_batch(_numbered(df, batch_id), f"{run}/{folder.name}", fmt, partition_by=partition_by)
    return folder


def commit_folder(
    df: DataFrame, run: str, folder: Folder, fmt: str = "parquet", note: Callable[[dict], dict] = lambda notes: notes
) -> None:
    """Make a folder that holds the frame's rows count."""
    schema = _numbered(df, folder.number).schema

    def change(document: dict | None) -> dict:
        after = Manifest.of(document).with_batch(folder, schema, fmt)
        return replace(after, notes=note(after.notes)).document()

    commit(df.sparkSession, run, change)


def commit_notes(spark: SparkSession, run: str, note: Callable[[dict], dict]) -> None:
    """Keep notes of a micro-batch that has no rows to store."""

    def change(document: dict | None) -> dict:
        held = Manifest.of(document)
        return replace(held, notes=note(held.notes)).document()

    commit(spark, run, change)


def read_folders(
    spark: SparkSession, run: str, folders: Sequence[Folder], schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """The rows of a run's folders with their declared types, partition columns too.

    Folders of one layout are one scan, with the run as base of their partition columns.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for folder in folders:
        layouts.setdefault(folder.partition_by, []).append(f"{run}/{folder.name}")
    if not layouts:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).schema(schema).option("basePath", run)
    return reduce(DataFrame.unionByName, (reader.load(paths).select(schema.names) for paths in layouts.values()))


def read_live(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of the newest run, with the schema they were written with unless one is given.

    Nothing stored reads as no rows of the given schema.
    """
    run = current_run(spark, path)
    held = manifest(spark, run) if run else Manifest()
    return read_folders(spark, run or path, held.folders, schema or held.schema, held.fmt)


def compact(
    spark: SparkSession,
    path: str,
    fold: Callable[[DataFrame], DataFrame],
    schema: StructType | None = None,
    partition_by: Sequence[str] | None = None,
    remove: bool = False,
    beside: Callable[[str, Manifest, Folder], dict] = lambda run, held, base: held.notes,
) -> None:
    """Fold the folders of the newest run into one base, partitioned as the newest of them unless told otherwise.

    ``remove`` deletes what no longer counts; do so only while no reader that began before is at work.
    ``beside`` may store more for the base, and gives the notes that go with it.
    """
    run = current_run(spark, path)
    if run is None:
        return
    held = manifest(spark, run)
    if len(held.folders) > 1:
        newest = held.folders[-1]
        base = Folder.new("base", newest.number, newest.partition_by if partition_by is None else partition_by)
        rows = fold(read_folders(spark, run, held.folders, schema or held.schema, held.fmt))
        write_batch(rows, f"{run}/{base.name}", held.fmt, partition_by=base.partition_by)
        notes = beside(run, held, base)
        commit(spark, run, lambda d: replace(Manifest.of(d).without(held.folders, base), notes=notes).document())
    if remove:
        sweep(spark, run)


def sweep(spark: SparkSession, run: str) -> None:
    """Delete the folders of a run that were replaced, what cut-off attempts left behind, and what lies beside them."""
    held = manifest(spark, run)
    counts = {f.name for f in held.folders}
    newest = max((f.number for f in held.folders), default=-1)
    for found in listed(spark, run):
        _, is_folder, rest = found.partition(_FOLDER)
        name = f"{_FOLDER}{rest}"
        kind, _, number = rest.rpartition("-")[0].partition("-")
        cut_off = name not in counts and kind == "batch" and int(number) <= newest
        if is_folder and (name in held.dropped or cut_off):
            removed(spark, f"{run}/{found}")

    def change(document: dict | None) -> dict:
        now = Manifest.of(document)
        return replace(now, dropped=tuple(n for n in now.dropped if n not in held.dropped)).document()

    if held.dropped:
        commit(spark, run, change)


def expire(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the newest ``keep`` folders of the newest run: for whole results only."""
    run = current_run(spark, path)
    if run is None:
        return
    old = manifest(spark, run).folders[:-keep]
    if old:
        commit(spark, run, lambda d: Manifest.of(d).without(old).document())
    sweep(spark, run)

"""Whole tables replaced at once: each write is a folder of its own, and one commit makes it the table.

Readers follow the last commit, so they see one version whole, also while the next one is written or after its
write was cut off.
"""

import json
from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from delayworks.sinks.commits import commit, latest, listed, removed
from delayworks.sinks.files import write_batch
from delayworks.sources import read_batch

_VERSION = "version="


def write_version(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    keep: int = 2,
) -> None:
    """Replace the table at ``path``. The newest ``keep`` versions stay, for readers that began before.

    Of two writers at once the later commit is the table. What cut-off writes left goes with the next write.
    """
    spark, name = df.sparkSession, f"{_VERSION}{uuid4().hex[:12]}"
    before = {n for n in listed(spark, path) if n.startswith(_VERSION)}
    write_batch(df, f"{path}/{name}", fmt, partition_by=partition_by, options=options)
    schema = json.loads(df.schema.json())

    def change(document: dict | None) -> dict:
        former = document["versions"] if document else []
        return {"versions": [name, *former][:keep], "fmt": fmt, "schema": schema}

    kept = commit(spark, path, change)["versions"]
    for old in before.difference(kept):
        removed(spark, f"{path}/{old}")


def read_current(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The table at ``path``: its current version, or all files where it was never written by version."""
    document = latest(spark, path)
    if document is None:
        return read_batch(spark, path, fmt, schema)
    schema = schema or StructType.fromJson(document["schema"])
    return read_batch(spark, f"{path}/{document['versions'][0]}", document["fmt"], schema)

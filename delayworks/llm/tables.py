"""Intermediate tables, and the package on the executors' path."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.scratch import scratch_dir

_ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers on the same file system import this package from where it lies.

    On other machines install the package or give it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([_ROOT, *filter(None, paths)])


def stored(df: DataFrame, name: str, **options: int) -> DataFrame:
    """The frame written as Parquet to the shared scratch folder, and read again; ``options`` are the writer's.

    It cuts the lineage: what follows survives lost executors without repeating the work.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as set it apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drawn(df: DataFrame, size: int, key: str) -> DataFrame:
    """About ``size`` of the rows, by the hash of a key that tells them apart; all if there are no more.

    A threshold on the hash, not a sort: each task sends its share of the sample and no more.
    """
    total, scale = df.count(), 1 << 40
    return df if total <= size else df.where(F.pmod(F.xxhash64(key), F.lit(scale)) < int(size / total * scale))

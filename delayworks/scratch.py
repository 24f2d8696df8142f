"""Folders for intermediate tables and stream checkpoints."""

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/delayworks-{name}-{uuid4().hex}"


def set_scratch(spark: SparkSession, folder: str) -> None:
    """Use a folder as the shared one, unless the session has one already."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(folder)

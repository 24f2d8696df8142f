"""Row counts around a step."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def profile_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(stage, rows)`` of two stored layers: a count over Parquet reads footers only.

    For frames that aren't stored yet see ``profile_step``.
    """

    def counted(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).select(F.lit(stage).alias("stage"), "rows")

    return counted(before, "before").unionAll(counted(after, "after"))


def profile_step(
    before: DataFrame, step: Callable[[DataFrame], DataFrame], store: Callable[[DataFrame], object]
) -> DataFrame:
    """``(stage, rows)`` before and after a step, counted while ``store`` writes its result once.

    The input is read once, by the write's own job. ``store`` must take all rows.
    """
    stages = {stage: Observation() for stage in ("before", "after")}

    def counted(df: DataFrame, stage: str) -> DataFrame:
        return df.observe(stages[stage], F.count(F.lit(1)).alias("rows"))

    store(counted(step(counted(before, "before")), "after"))
    rows = [(stage, seen.get["rows"]) for stage, seen in stages.items()]
    return before.sparkSession.createDataFrame(rows, "stage string, rows long")

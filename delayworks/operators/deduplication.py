"""Keeping one row per key, in batch and on streams."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank_in_key"
_SPLIT = "__split_of_key"
_BATCH_TIME = "__batch_time"


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key; NULL keys are equal to each other.

    Without an order any row of the key may survive. With one, the first row
    does; give a total order for repeatable results. Both forms drop copies on
    the map side before the shuffle (a partial aggregate, or a partial group
    limit under the window), so a key with very many rows sends at most one row
    per map task.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    within_key = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn(_RANK, F.row_number().over(within_key))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    delay: str | None = None,
    hot_key_splits: int = 256,
) -> DataFrame:
    """One row per key over the life of the stream: the first to arrive.

    That state, an entry per key, is never dropped. With ``event_time`` and
    ``delay`` it is bounded by the watermark instead: copies further apart than
    ``delay`` may both survive, and rows behind the watermark are dropped.

    A stateful operator has no map-side step, so every copy of a key would go
    to one task. ``hot_key_splits`` > 1 first removes copies per key and group of
    input splits within a micro-batch, which spreads a hot key over up to that
    many tasks, and then per key, which decides. The first step forgets a
    micro-batch when the next one is done; its price is a second shuffle. 1 turns
    it off. Keep the choice for the life of a checkpoint.
    """
    keys = list(keys)
    if (event_time is None) != (delay is None):
        raise ValueError("event_time and delay go together")
    if event_time is not None:
        df = df.withWatermark(event_time, delay)
    if hot_key_splits > 1:
        # The time of the micro-batch, in the key, keeps the first step to copies of one micro-batch.
        helpers = {_SPLIT: F.spark_partition_id() % hot_key_splits, _BATCH_TIME: F.current_timestamp()}
        df = df.withColumns(helpers)
        if event_time is None:
            # Batch times only grow, so no row is ever behind this watermark.
            df = df.withWatermark(_BATCH_TIME, "0 seconds")
        df = df.dropDuplicatesWithinWatermark([*keys, *helpers]).drop(*helpers)
    return df.dropDuplicates(keys) if event_time is None else df.dropDuplicatesWithinWatermark(keys)

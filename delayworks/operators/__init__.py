"""DataFrame -> DataFrame operators, usable on batch and streaming frames alike."""

from delayworks.operators.cleaning import clamp_min, fill_nulls, flag_at_least
from delayworks.operators.conforming import conform, rescue_columns
from delayworks.operators.deduplication import dedup, dedup_stream
from delayworks.operators.profiling import profile_counts, profile_step
from delayworks.operators.stamping import stamp_arrival_time, stamp_ingestion

__all__ = [
    "clamp_min",
    "conform",
    "dedup",
    "dedup_stream",
    "fill_nulls",
    "flag_at_least",
    "profile_counts",
    "profile_step",
    "rescue_columns",
    "stamp_arrival_time",
    "stamp_ingestion",
]

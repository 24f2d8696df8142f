"""Streaming layers: consume what is new, then stop."""

from delayworks.streaming.config import StreamInput, StreamOutput
from delayworks.streaming.counts import read_counts
from delayworks.streaming.gold import (
    compact_changes,
    compact_totals,
    daily_route_by_arrival,
    daily_route_by_event_time,
    daily_route_partials,
    read_arrivals,
    read_changes,
    read_days,
    read_snapshot,
    read_totals,
)
from delayworks.streaming.jobs import EVENT_TIME_COLUMN, bronze_stream, gold_stream, read_bronze, silver_stream
from delayworks.streaming.late import compact_late, read_late
from delayworks.streaming.silver import compact_silver, read_silver

__all__ = [
    "EVENT_TIME_COLUMN",
    "StreamInput",
    "StreamOutput",
    "bronze_stream",
    "compact_changes",
    "compact_late",
    "compact_silver",
    "compact_totals",
    "daily_route_by_arrival",
    "daily_route_by_event_time",
    "daily_route_partials",
    "gold_stream",
    "read_arrivals",
    "read_bronze",
    "read_changes",
    "read_counts",
    "read_days",
    "read_late",
    "read_silver",
    "read_snapshot",
    "read_totals",
    "silver_stream",
]

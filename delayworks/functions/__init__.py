"""Column expressions shared by the operators and the plans."""

from delayworks.functions.expressions import (
    at_least,
    clamped,
    column,
    flight_day_instant,
    instant_day,
    is_late,
    overall_delay,
    percent,
)

__all__ = [
    "at_least",
    "clamped",
    "column",
    "flight_day_instant",
    "instant_day",
    "is_late",
    "overall_delay",
    "percent",
]

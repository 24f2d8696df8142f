"""Layer definitions: pure plans and the batch jobs that store them."""

from delayworks.plans.batch import bronze_batch, gold_batch, silver_batch
from delayworks.plans.gold import (
    GOLD_PLANS,
    daily_route_measures,
    gold_daily_route,
    gold_monthly_carrier,
    gold_route_performance,
)
from delayworks.plans.silver import clean_flights, silver_transform

__all__ = [
    "GOLD_PLANS",
    "bronze_batch",
    "clean_flights",
    "daily_route_measures",
    "gold_batch",
    "gold_daily_route",
    "gold_monthly_carrier",
    "gold_route_performance",
    "silver_batch",
    "silver_transform",
]

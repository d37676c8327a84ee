"""Scalar expressions. Everything here returns a ``Column`` built from Spark's own functions."""

from wayfare.functions.fingerprint import fingerprint, fingerprint_sql
from wayfare.functions.scalar import (
    day_name,
    duration_minutes_exact,
    duration_minutes_whole,
    epoch_seconds,
    initials,
    is_weekend,
    month_name,
    payment_key,
    rate_key,
    sunday_based_weekday,
    varchar,
)

__all__ = [
    "day_name",
    "duration_minutes_exact",
    "duration_minutes_whole",
    "epoch_seconds",
    "fingerprint",
    "fingerprint_sql",
    "initials",
    "is_weekend",
    "month_name",
    "payment_key",
    "rate_key",
    "sunday_based_weekday",
    "varchar",
]

"""Scalar column expressions (day/hour keys, Java-compatible comparisons, rounding)."""

from agrosense.functions.columns import (
    date_text,
    day_key,
    field_count,
    hour_key,
    hour_start,
    hour_text,
    interval_text,
    java_gt,
    java_lt,
    reading_time,
    round_half_up,
    safe_ratio,
    to_number,
)

__all__ = [
    "date_text", "day_key", "field_count", "hour_key", "hour_start", "hour_text",
    "interval_text", "java_gt", "java_lt", "reading_time", "round_half_up", "safe_ratio",
    "to_number",
]

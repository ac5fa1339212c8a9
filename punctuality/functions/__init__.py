"""Column functions. All are built-in expressions, so they stay inside whole-stage code generation."""

from punctuality.functions.clock import clock_seconds, instant, service_date, service_day_seconds
from punctuality.functions.figures import mean_minutes, part_of_total_pct, rate_pct
from punctuality.functions.text import (
    leading_value,
    line_code,
    line_title,
    reason_title,
    stop_key,
)
from punctuality.functions.verdict import cancelled, flags_of, reason, report_code, unreported

__all__ = [
    "cancelled",
    "clock_seconds",
    "flags_of",
    "instant",
    "leading_value",
    "line_code",
    "line_title",
    "mean_minutes",
    "part_of_total_pct",
    "rate_pct",
    "reason",
    "reason_title",
    "report_code",
    "service_date",
    "service_day_seconds",
    "stop_key",
    "unreported",
]

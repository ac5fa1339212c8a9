"""Rounded figures over counts and sums that are whole numbers, so results do not depend on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate_pct(hits: Column, rows: Column) -> Column:
    """Share of ``hits`` in ``rows`` as a percentage with two decimals."""
    return F.round(hits / rows * 100, 2)


def mean_minutes(hundredths: Column, rows: Column) -> Column:
    """Mean in minutes with two decimals, from a sum in hundredths of a minute; NULL without rows."""
    return F.round(F.try_divide(hundredths, rows * 100), 2)


def part_of_total_pct(part: Column, total: Column) -> Column:
    """Percentage of a total, 0 where the total is zero or missing."""
    return F.when(total != 0, rate_pct(part, total)).otherwise(F.lit(0.0))

"""What became of a passage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words, compared in lower case, and reason codes.
STATUS_CANCELLED = "cancelled"
STATUS_NO_REPORT = "noreport"
CANCELLED_SERVICE = "cancelled_service"
DELAY = "delay"
MISSING_STATUS = "missing_realtime_status"
NORMAL = "normal"


def _either(status: str, departure: Column, arrival: Column) -> Column:
    return (F.lower(departure) == status) | (F.lower(arrival) == status)


def cancelled(departure: Column, arrival: Column) -> Column:
    """Whether either side says cancelled. NULL when one side is missing and the other says something else."""
    return _either(STATUS_CANCELLED, departure, arrival)


def unreported(departure: Column, arrival: Column) -> Column:
    """Whether either side lacks a report, with the same three values as :func:`cancelled`."""
    return _either(STATUS_NO_REPORT, departure, arrival)


def report_code(is_cancelled: Column, is_unreported: Column) -> Column:
    """Both flags, of three values each, as one number: the smaller, the graver. As a number it can be reduced by a
    hash aggregate. :func:`flags_of` gives the flags back."""

    def digit(flag: Column) -> Column:
        return F.when(flag, 0).when(~flag, 2).otherwise(1)

    return (digit(is_cancelled) * 3 + digit(is_unreported)).cast("tinyint")


def flags_of(code: Column) -> tuple[Column, Column]:
    """(is_cancelled, is_unreported) of a report code."""

    def flag(digit: Column) -> Column:
        return F.when(digit == 0, True).when(digit == 2, False)

    return flag(F.floor(code / 3)), flag(code % 3)


def reason(is_cancelled: Column, is_delayed: Column, is_unreported: Column) -> Column:
    """Reason code: a cancellation outranks a delay, a delay outranks a missing report. Never NULL."""
    ranked = ((is_cancelled, CANCELLED_SERVICE), (is_delayed, DELAY), (is_unreported, MISSING_STATUS))
    return F.coalesce(*[F.when(holds, F.lit(code)) for holds, code in ranked], F.lit(NORMAL))

"""Clock times and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctuality.config import DAY_SECONDS


def clock_seconds(text: Column) -> Column:
    """Seconds of an ``H:M:S`` text. Hours may pass 24; anything that is not three whole numbers gives NULL.

    A fraction is cut off. The sum is taken in 64 bits, so absurd hours give NULL instead of an overflow error.
    """
    pieces = F.split(text, ":")

    def number(position: int) -> Column:
        whole = F.substring_index(F.get(pieces, F.lit(position)), ".", 1)
        return whole.try_cast("int").cast("bigint")

    return (number(0) * 3_600 + number(1) * 60 + number(2)).try_cast("int")


def instant(text: Column) -> Column:
    """ISO-8601 text to a timestamp; unreadable text gives NULL under ANSI mode as well."""
    return F.try_to_timestamp(text)


def service_date(ts: Column, rollover_hour: int, time_zone: str | None = None) -> Column:
    """The service day ``ts`` belongs to: hours before the rollover hour count to the day before. Zones as in
    :func:`service_day_seconds`."""
    if time_zone is None:
        return F.date_sub(F.to_date(ts), F.when(F.hour(ts) < rollover_hour, 1).otherwise(0))
    local = F.unix_seconds(F.from_utc_timestamp(ts, time_zone)) - rollover_hour * 3_600
    return F.date_from_unix_date(F.floor(local / DAY_SECONDS).cast("int"))


def service_day_seconds(ts: Column, rollover_hour: int, time_zone: str | None = None) -> Column:
    """Clock seconds of ``ts`` within the service day; times before the rollover hour count past midnight.

    With ``time_zone`` the instant is read in that zone whatever the session zone is. Without it the session
    zone is used, and a timestamp without zone is taken as it stands.
    """
    if time_zone is None:
        seconds = F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
    else:
        local = F.unix_seconds(F.from_utc_timestamp(ts, time_zone))
        seconds = F.pmod(local, F.lit(DAY_SECONDS)).cast("int")
    return seconds + F.when(seconds < rollover_hour * 3_600, DAY_SECONDS).otherwise(0)

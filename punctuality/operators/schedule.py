"""Planned departures from the four feed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality import schemas
from punctuality.functions import line_code
from punctuality.operators.nearest import first_per_key


def build_schedule(routes: DataFrame, trips: DataFrame, stop_times: DataFrame, stops: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per distinct planned departure of a known line at a named stop.

    The line of a trip is settled on the trip table, before the large stop-times table is touched, and trips
    without a line are dropped there. Trips without a route row stay when their route id carries a code. Stop
    times at unknown or unnamed stops could only be dropped later, so that join is an inner one. Without ``distinct``
    repeated rows stay, which spares a shuffle where the next step reduces them anyway, as the match does.
    """
    lines = (
        trips.join(routes, "route_id", "left")
        .withColumn("line_code", line_code(F.col("route_id"), F.col("route_short_name")))
        .filter(F.col("line_code").isNotNull())
        .select("trip_id", "line_code", "route_short_name")
    )
    named_stops = stops.filter(F.col("stop_name").isNotNull())
    rows = stop_times.join(lines, "trip_id").join(named_stops, "stop_id").select(*schemas.names(schemas.SCHEDULE))
    # By a sort instead of two hash tables: rows of a trip have met in one task already, which then holds its rows once.
    return first_per_key(rows, rows.columns, ["trip_id"]) if distinct else rows

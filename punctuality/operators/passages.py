"""Observed passages from snapshot documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality import schemas
from punctuality.functions import instant, leading_value, line_code


def flatten_snapshots(documents: DataFrame) -> DataFrame:
    """One row per visit of every delivery, for batch and streaming frames alike.

    Deliveries without visits and documents without deliveries give no row: the row of NULLs an outer explode
    would give has no stop and :func:`build_passages` would drop it.
    """
    visits = documents.select(
        "source_file", F.explode("Siri.ServiceDelivery.StopMonitoringDelivery").alias("delivery")
    ).select("source_file", F.explode("delivery.MonitoredStopVisit").alias("visit"))
    call = F.col("visit.MonitoredVehicleJourney.MonitoredCall")
    return visits.select(
        "source_file",
        F.col("visit.RecordedAtTime").alias("recorded_at_time"),
        F.col("visit.MonitoringRef.value").alias("monitoring_ref"),
        F.col("visit.MonitoredVehicleJourney.LineRef.value").alias("line_ref"),
        leading_value(call["StopPointName"]).alias("stop_point_name"),
        call["ExpectedDepartureTime"].alias("expected_departure_time"),
        call["DepartureStatus"].alias("departure_status"),
        call["ArrivalStatus"].alias("arrival_status"),
    )


def build_passages(visits: DataFrame) -> DataFrame:
    """Visits at a known stop, with line code and parsed instants."""
    return (
        visits.filter("monitoring_ref IS NOT NULL AND stop_point_name IS NOT NULL")
        .withColumns(
            {
                "line_code": line_code(F.col("line_ref"), F.col("line_ref")),
                "recorded_at_ts": instant(F.col("recorded_at_time")),
                "expected_departure_ts": instant(F.col("expected_departure_time")),
            }
        )
        .select(*schemas.names(schemas.PASSAGES))
    )

"""What the collected snapshot files hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.functions import cancelled

# Fixed value: form of a snapshot file name, made of the monitoring reference and the collection time.
FILE_NAME_PATTERN = r"^snapshot_(.*)_(\d{8}_\d{6})\.json$"
FILE_TIME_FORMAT = "yyyyMMdd_HHmmss"


def audit_snapshots(documents: DataFrame) -> DataFrame:
    """One row per snapshot document: reference and time from its name, what its text turned out to be, visits, usable
    visits, time range. A damaged document has a status that says so, and 0 visits; frames without status give none.

    ``cancelled_without_time`` counts cancelled visits that the match drops because they have no expected time.

    ``nb_passages`` counts the first delivery, as the collector does; ``visits`` counts all of them. A document is
    one row already, so nothing is exploded or shuffled.
    """
    deliveries = F.col("Siri.ServiceDelivery.StopMonitoringDelivery")
    listed = F.transform(
        deliveries, lambda delivery: F.coalesce(delivery["MonitoredStopVisit"], F.array())
    )
    visits = F.coalesce(F.flatten(listed), F.array())

    def usable(visit: Column) -> Column:
        names = visit["MonitoredVehicleJourney"]["MonitoredCall"]["StopPointName"]
        named = F.get(names, F.lit(0))["value"].isNotNull()
        return visit["MonitoringRef"]["value"].isNotNull() & named

    def untimed(visit: Column) -> Column:
        call = visit["MonitoredVehicleJourney"]["MonitoredCall"]
        gone = cancelled(call["DepartureStatus"], call["ArrivalStatus"])
        return F.coalesce(gone, F.lit(False)) & call["ExpectedDepartureTime"].isNull()

    recorded = F.transform(F.col("all_visits"), lambda visit: visit["RecordedAtTime"])
    told = ["status"] if "status" in documents.columns else []
    return documents.select("source_file", *told, visits.alias("all_visits"), listed.alias("listed")).select(
        "source_file",
        *told,
        F.replace(F.regexp_extract("source_file", FILE_NAME_PATTERN, 1), F.lit("_"), F.lit(":")).alias(
            "monitoring_ref"
        ),
        F.try_to_timestamp(
            F.regexp_extract("source_file", FILE_NAME_PATTERN, 2), F.lit(FILE_TIME_FORMAT)
        ).alias("collected_at"),
        F.coalesce(F.array_size("listed"), F.lit(0)).alias("deliveries"),
        F.coalesce(F.array_size(F.get("listed", F.lit(0))), F.lit(0)).alias("nb_passages"),
        F.array_size("all_visits").alias("visits"),
        F.array_size(F.filter("all_visits", usable)).alias("usable_visits"),
        F.array_size(F.filter("all_visits", untimed)).alias("cancelled_without_time"),
        F.array_min(recorded).alias("first_recorded_at"),
        F.array_max(recorded).alias("last_recorded_at"),
    )


def audit_with_reports(audit: DataFrame, reports: DataFrame) -> DataFrame:
    """Audit rows next to what the collector reported. Failed collections have no file and a file may have no
    report, so both sides are kept whole. Failed ones pass by the join: they would all meet under one NULL key."""
    said = reports.select(
        F.col("snapshot_file").alias("source_file"),
        F.col("monitoring_ref").alias("reported_ref"),
        "status_code",
        "ok",
        "error",
        F.col("nb_passages").alias("reported_passages"),
        F.try_to_timestamp("collected_at").alias("reported_at"),
    )
    about_files = audit.join(said.filter("source_file IS NOT NULL"), "source_file", "full")
    return about_files.unionByName(said.filter("source_file IS NULL"), allowMissingColumns=True)

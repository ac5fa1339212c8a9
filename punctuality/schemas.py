"""Table layouts. Column names, order and types are fixed values: other systems read these datasets."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType

# Feed columns that are read; a feed may carry more, in any order.
FEED_COLUMNS = {
    "routes": ("route_id", "route_short_name"),
    "trips": ("route_id", "trip_id"),
    "stops": ("stop_id", "stop_name"),
    "stop_times": ("trip_id", "stop_id", "departure_time"),
}

# Dataset layouts.
SCHEDULE = "line_code string, route_short_name string, trip_id string, stop_name string, departure_time string"

PASSAGES = (
    "source_file string, recorded_at_time string, recorded_at_ts timestamp, monitoring_ref string, "
    "line_ref string, line_code string, stop_point_name string, expected_departure_time string, "
    "expected_departure_ts timestamp, departure_status string, arrival_status string"
)

MATCHED = (
    "source_file string, recorded_at_time string, recorded_at_ts timestamp, monitoring_ref string, "
    "line_code string, route_short_name string, stop_point_name string, expected_departure_time string, "
    "expected_departure_ts timestamp, departure_time string, match_gap_minutes double, delay_minutes double, "
    "is_delayed boolean, is_cancelled boolean, is_disrupted boolean, disruption_reason string"
)

LINE_PERFORMANCE = (
    "line_code string, route_short_name string, observations bigint, avg_delay_minutes double, "
    "delay_rate_pct double, disruption_rate_pct double"
)

STOP_PERFORMANCE = "stop_point_name string, observations bigint, avg_delay_minutes double, disruption_rate_pct double"

DISRUPTION_REASONS = "disruption_reason string, events bigint"

NETWORK_OVERVIEW = (
    "total_observations bigint, disrupted_observations bigint, cancelled_observations bigint, "
    "network_avg_delay_minutes double"
)


def names(layout: str) -> list[str]:
    """Column names of a layout, in order."""
    return StructType.fromDDL(layout).fieldNames()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_TEXT = StringType()
_VALUE = _struct(value=_TEXT)

_VISIT = _struct(
    RecordedAtTime=_TEXT,
    MonitoringRef=_VALUE,
    MonitoredVehicleJourney=_struct(
        LineRef=_VALUE,
        MonitoredCall=_struct(
            StopPointName=ArrayType(_VALUE),
            ExpectedDepartureTime=_TEXT,
            DepartureStatus=_TEXT,
            ArrivalStatus=_TEXT,
        ),
    ),
)

# One snapshot document. Stated, not inferred: inference costs a pass over all files and drifts with stray ones.
SNAPSHOT = _struct(
    Siri=_struct(
        ServiceDelivery=_struct(
            StopMonitoringDelivery=ArrayType(_struct(MonitoredStopVisit=ArrayType(_VISIT))),
        ),
    ),
)

# A snapshot file as it is kept after its first reading: parsed, or with its text where that could not be read whole.
DOCUMENTS = StructType(
    [
        StructField("source_file", _TEXT),
        StructField("bytes", LongType()),
        StructField("modified_at", TimestampType()),
        StructField("status", _TEXT),
        StructField("document", _TEXT),
        *SNAPSHOT.fields,
    ]
)

# Additive figures of matched rows by line, stop and reason.
ROLLUP = (
    "line_code string, route_short_name string, stop_point_name string, disruption_reason string, "
    "observations bigint, delay_hundredths bigint, delayed bigint, disrupted bigint, cancelled bigint"
)

# What is kept of a disrupted observation that may be listed as a sample.
SAMPLES = (
    "line_code string, stop_point_name string, expected_departure_time string, delay_minutes double, "
    "is_disrupted boolean, disruption_reason string"
)

# One entry of a collection report; a report file is a JSON list of these.
COLLECTION_REPORT = (
    "monitoring_ref string, status_code int, nb_passages bigint, ok boolean, snapshot_file string, "
    "error string, collected_at string"
)

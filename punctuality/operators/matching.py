"""Passages against planned departures, and the verdict on each match."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality import schemas
from punctuality.config import MatchConfig
from punctuality.functions import (
    cancelled,
    clock_seconds,
    flags_of,
    reason,
    report_code,
    service_date,
    service_day_seconds,
    stop_key,
    unreported,
)
from punctuality.functions.verdict import NORMAL
from punctuality.operators import nearest

GROUP = ("line_code", "stop_key")
PLANNED_TIE = ("trip_id", "departure_time", "route_short_name", "stop_name")

# What makes two passages the same observation. Vehicles that agree on all of it become one row.
PASSAGE_KEY = (
    "source_file",
    "recorded_at_time",
    "monitoring_ref",
    "line_code",
    "stop_point_name",
    "expected_departure_time",
)
MERGED = ("recorded_at_ts", "expected_departure_ts", "expected_seconds", "report")


def _known(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in each column, written so that it reaches the scan."""
    return rows.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def planned_departures(schedule: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Schedule rows that can be matched: known line and stop, readable clock time."""
    # The clock text is parsed in a one-element unnest. As a plain column the optimizer would copy the whole parse
    # into every filter on the seconds, and into the scan's filter once more.
    seconds = F.explode(F.array(clock_seconds(F.col("departure_time"))))
    placed = (
        _known(schedule, "line_code", "stop_name", "departure_time")
        .withColumn("stop_key", stop_key(F.col("stop_name"), config.collapse_whitespace))
        .withColumn("planned_seconds", seconds)
    )
    return _known(placed, "planned_seconds")


def _reports(passages: DataFrame, config: MatchConfig) -> DataFrame:
    """Passages that can be matched, cut to what the match needs: the statuses as one number, and the expected time
    as seconds, computed here so that nothing after the aggregate repeats the zone arithmetic."""
    statuses = F.col("departure_status"), F.col("arrival_status")
    seconds = service_day_seconds(F.col("expected_departure_ts"), config.rollover_hour, config.time_zone)
    return _known(passages, "line_code", "stop_point_name", "expected_departure_ts").select(
        *PASSAGE_KEY,
        "recorded_at_ts",
        "expected_departure_ts",
        seconds.alias("expected_seconds"),
        report_code(cancelled(*statuses), unreported(*statuses)).alias("report"),
    )


def _placed(reports: DataFrame, config: MatchConfig) -> DataFrame:
    is_cancelled, is_unreported = flags_of(F.col("report"))
    return reports.withColumns(
        {
            "stop_key": stop_key(F.col("stop_point_name"), config.collapse_whitespace),
            "is_cancelled": is_cancelled,
            "is_unreported": is_unreported,
        }
    ).drop("report")


def observed_departures(passages: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """One row per observation: known line and stop, readable expected time, and the gravest report about it.

    Passages of one observation share line, stop and expected time, hence the planned departure, so they are
    reduced to one before the match. The aggregate works on numbers only (times are equal within a key), which
    makes it a hash aggregate that merges copies before the shuffle.
    """
    merged = _reports(passages, config).groupBy(*PASSAGE_KEY).agg(*[F.min(c).alias(c) for c in MERGED])
    return _placed(merged, config)


def span_parameters(config: MatchConfig) -> dict[str, int]:
    """What spans depend on, apart from the bucket width, which they bring along."""
    return {
        "tolerance": config.tolerance_seconds,
        "first": config.first_second,
        "last": config.last_second,
        "collapse_whitespace": int(config.collapse_whitespace),
    }


def departure_spans(schedule: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """For each planned departure the expected times it is the match of. Worth keeping as a dataset: it depends on
    the schedule alone and serves every batch of passages."""
    spans = nearest.winning_spans(
        planned_departures(schedule, config),
        on=GROUP,
        time="planned_seconds",
        tie=PLANNED_TIE,
        tolerance=config.tolerance_seconds,
        first=config.first_second,
        last=config.last_second,
        bucket=config.bucket_seconds,
    )
    return spans.withMetadata("bucket", nearest.made_under(spans) | span_parameters(config))


def _checked(spans: DataFrame, config: MatchConfig) -> dict[str, int]:
    """The parameters spans were made under, which must be those of the config."""
    made = nearest.made_under(spans)
    differing = {name: made.get(name) for name, value in span_parameters(config).items() if made.get(name) != value}
    if differing:
        raise ValueError(f"spans were made under another config: {differing}")
    return made


def match_to_spans(passages: DataFrame, spans: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Passages with their planned departure, given :func:`departure_spans` made under the same config.

    Spans made under other parameters are refused; their bucket width is taken as it is.
    """
    _checked(spans, config)
    return nearest.join_spans(observed_departures(passages, config), spans, GROUP, "expected_seconds")


def match_to_loads(
    passages: DataFrame, loads: Sequence[tuple[str | None, DataFrame]], config: MatchConfig = MatchConfig()
) -> DataFrame:
    """:func:`match_to_spans` with the spans of each passage's service date.

    ``loads`` are pairs of a date and the spans that hold from it on, until the next one's date; no two dates are equal, and
    None is before all others. Passages of an earlier date than the first have no match. All loads meet the passages
    in one join, whose key has the number of the load, so a passage still finds at most one span.
    """
    if not loads:
        raise ValueError("no spans to match to")
    loads = sorted(loads, key=lambda load: load[0] or "")
    if len({date for date, _ in loads}) < len(loads):
        raise ValueError("two loads for one date")
    made = {tuple(sorted(_checked(spans, config).items())) for _, spans in loads}
    if len(made) > 1:
        raise ValueError("spans were made under several bucket widths")
    numbered = [spans.withColumn("load", F.lit(n)) for n, (_, spans) in enumerate(loads)]
    spans = reduce(DataFrame.unionByName, numbered).withMetadata("bucket", dict(made.pop()))
    day = service_date(F.col("expected_departure_ts"), config.rollover_hour, config.time_zone).cast("string")
    starts = F.array(*[F.lit(date or "") for date, _ in loads])
    number = F.array_size(F.filter(starts, lambda start: start <= day)) - 1
    observed = observed_departures(passages, config).withColumn("load", number)
    return nearest.join_spans(observed, spans, (*GROUP, "load"), "expected_seconds").drop("load")


def changed_spans(old: DataFrame, new: DataFrame) -> DataFrame:
    """The spans of seconds, by line, stop and bucket, in which two sets of spans do not give the same planned departure.

    Spans are compared within each bucket, so one that has become longer or shorter differs in the buckets of its end alone.
    """
    made = nearest.made_under(old)
    if made != nearest.made_under(new):
        raise ValueError("spans were made under different parameters")
    border = F.col("bucket") * made["bucket"]
    inside = {
        "span_start": F.greatest("span_start", border),
        "span_end": F.least("span_end", border + (made["bucket"] - 1)),
    }
    both = old.withColumn("side", F.lit(1)).unionByName(new.withColumn("side", F.lit(-1))).withColumns(inside)
    differing = both.groupBy(*old.columns).agg(F.sum("side").alias("side")).filter("side <> 0")
    places = differing.select(*GROUP, "bucket", "span_start", "span_end").distinct()
    return places.withMetadata("bucket", made)


def hit_by(rows: DataFrame, spans: DataFrame, config: MatchConfig = MatchConfig(), missed: bool = False) -> DataFrame:
    """The passages or matched rows whose expected time lies in one of the spans; with ``missed`` all others.

    Whether a row is hit hangs on its line, stop and expected time alone, so an observation's passages and its match agree.
    """
    seconds = service_day_seconds(F.col("expected_departure_ts"), config.rollover_hour, config.time_zone)
    width = nearest.made_under(spans)["bucket"]
    keys = {
        "stop_key": stop_key(F.col("stop_point_name"), config.collapse_whitespace),
        "bucket": F.floor(seconds / width).cast("int"),
    }
    o, s = rows.withColumns(keys | {"expected_seconds": seconds}).alias("o"), spans.alias("s")
    same_cell = [F.col(f"o.{c}") == F.col(f"s.{c}") for c in (*GROUP, "bucket")]
    within = F.col("o.expected_seconds").between(F.col("s.span_start"), F.col("s.span_end"))
    return o.join(s, [*same_cell, within], "left_anti" if missed else "left_semi").select(*rows.columns)


def match_passages(passages: DataFrame, schedule: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Passages with their planned departure."""
    return match_to_spans(passages, departure_spans(schedule, config), config)


def match_passages_windowed(
    passages: DataFrame, schedule: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Same rows as :func:`match_passages`, through window functions: one to rank the passages of an observation,
    two to find the neighbours in time."""
    return nearest.nearest_match_windowed(
        _placed(nearest.first_per_key(_reports(passages, config), PASSAGE_KEY, ["report"]), config),
        planned_departures(schedule, config),
        on=GROUP,
        observed_time="expected_seconds",
        planned_time="planned_seconds",
        planned_tie=PLANNED_TIE,
        tolerance=config.tolerance_seconds,
        first=config.first_second,
        last=config.last_second,
    )


def candidate_statistics(
    passages: DataFrame, schedule: DataFrame, config: MatchConfig = MatchConfig()
) -> DataFrame:
    """Per line: how many pairs of passage and planned departure share line and stop, how many are within the
    tolerance, and the sum of their gaps; counted without producing the pairs."""
    per_stop = nearest.pair_statistics(
        _placed(_reports(passages, config), config),
        planned_departures(schedule, config),
        on=GROUP,
        observed_time="expected_seconds",
        planned_time="planned_seconds",
        tolerance=config.tolerance_seconds,
        first=config.first_second,
        last=config.last_second,
    )
    return per_stop.groupBy("line_code").agg(
        F.count(F.lit(1)).alias("stops"),
        F.sum("observed_rows").alias("observed_rows"),
        F.sum("planned_rows").alias("planned_rows"),
        F.sum("candidate_pairs").alias("candidate_pairs"),
        F.sum("pairs_in_tolerance").alias("pairs_in_tolerance"),
        F.sum("gap_seconds").alias("gap_seconds"),
    )


def judge(matches: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Delay, gap, flags and reason of each match. A positive delay is late, a negative one early.

    ``is_cancelled`` stays NULL where the statuses do not settle it; ``is_disrupted`` is never NULL, and a
    missing report counts as a disruption.
    """
    late_by = F.col("expected_seconds") - F.col("planned_seconds")
    flags = F.col("is_cancelled"), F.col("is_delayed"), F.col("is_unreported")
    return (
        matches.withColumns(
            {
                "delay_minutes": F.round(late_by / F.lit(60.0), 2),
                "match_gap_minutes": F.round(F.abs(late_by) / F.lit(60.0), 2),
            }
        )
        .withColumn("is_delayed", F.col("delay_minutes") >= config.delay_threshold_minutes)
        .withColumn("disruption_reason", reason(*flags))
        .withColumn("is_disrupted", F.col("disruption_reason") != NORMAL)
        .select(*schemas.names(schemas.MATCHED))
    )

"""Schedule, passages, match, verdict, indicators and rankings on small frames."""

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from punctuality import MatchConfig, schemas
from punctuality.operators import indicators, matching, ranking
from punctuality.operators.audit import audit_snapshots, audit_with_reports
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.operators.schedule import build_schedule

DAY = dt.datetime(2026, 1, 5)


def feed(spark, routes, trips, stop_times, stops):
    return dict(
        routes=spark.createDataFrame(routes, "route_id string, route_short_name string"),
        trips=spark.createDataFrame(trips, "route_id string, trip_id string"),
        stop_times=spark.createDataFrame(stop_times, "trip_id string, stop_id string, departure_time string"),
        stops=spark.createDataFrame(stops, "stop_id string, stop_name string"),
    )


def test_schedule_keeps_and_drops(spark):
    tables = feed(
        spark,
        routes=[("NET:C1", "A"), ("R2", "Bus"), ("R4", None)],
        trips=[("NET:C1", "t1"), ("R2", "t2"), ("NET:C3", "t3"), ("R4", "t4"), ("R5", "t5"), (None, "t6")],
        stop_times=[(f"t{i}", "s1", "08:00:00") for i in range(1, 8)]
        + [("t1", "s1", "08:00:00"), ("t1", "gone", "08:00:00"), ("t1", "s2", "09:00:00"), ("t2", "s1", None)],
        stops=[("s1", "Gare"), ("s2", None)],
    )
    assert rows_of(build_schedule(**tables)) == sorted(
        [
            ("C1", "A", "t1", "Gare", "08:00:00"),
            ("C3", None, "t3", "Gare", "08:00:00"),
            ("Bus", "Bus", "t2", "Gare", "08:00:00"),
            ("Bus", "Bus", "t2", "Gare", None),
        ],
        key=repr,
    )


def visit(ref="Q:1", line="REF:C1:", names=("Gare",), expected="2026-01-05T08:00:00", departure=None, arrival=None):
    return {
        "RecordedAtTime": "2026-01-05T07:59:00",
        "MonitoringRef": {"value": ref},
        "MonitoredVehicleJourney": {
            "LineRef": {"value": line},
            "MonitoredCall": {
                "StopPointName": None if names is None else [{"value": n} for n in names],
                "ExpectedDepartureTime": expected,
                "DepartureStatus": departure,
                "ArrivalStatus": arrival,
            },
        },
    }


def documents(spark, contents):
    rows = [
        (name, {"ServiceDelivery": {"StopMonitoringDelivery": deliveries}} if deliveries != "no service" else None)
        for name, deliveries in contents
    ]
    schema = f"source_file string, Siri {schemas.SNAPSHOT['Siri'].dataType.simpleString()}"
    return spark.createDataFrame(rows, schema)


CONTENTS = [
    (
        "snapshot_REF_StopPoint_Q_1__20260105_080102.json",
        [
            {"MonitoredStopVisit": [visit(), visit(names=["First", "Second"], expected="nope"), visit(names=[])]},
            {"MonitoredStopVisit": [visit(ref=None), visit(names=None), visit(line=None), None]},
            {"MonitoredStopVisit": []},
            {"MonitoredStopVisit": None},
            None,
        ],
    ),
    ("snapshot_x_20260105_080103.json", []),
    ("snapshot_x_20260105_080104.json", None),
    ("odd.json", "no service"),
]


def test_passages(spark):
    found = build_passages(flatten_snapshots(documents(spark, CONTENTS)))
    assert found.columns == schemas.names(schemas.PASSAGES)
    got = rows_of(found.select("stop_point_name", "line_code", "expected_departure_ts"))
    eight = dt.datetime(2026, 1, 5, 8)
    assert got == sorted([("Gare", "C1", eight), ("First", "C1", None), ("Gare", None, eight)], key=repr)


def test_audit(spark):
    audit = audit_snapshots(documents(spark, CONTENTS))
    got = {r.source_file: r for r in audit.collect()}
    first = got["snapshot_REF_StopPoint_Q_1__20260105_080102.json"]
    assert first.monitoring_ref == "REF:StopPoint:Q:1:"
    assert first.collected_at == dt.datetime(2026, 1, 5, 8, 1, 2)
    assert (first.deliveries, first.nb_passages, first.visits, first.usable_visits) == (5, 3, 7, 3)
    assert first.first_recorded_at == first.last_recorded_at == "2026-01-05T07:59:00"
    for name in ("snapshot_x_20260105_080103.json", "snapshot_x_20260105_080104.json"):
        assert (got[name].deliveries, got[name].nb_passages, got[name].visits, got[name].usable_visits) == (0,) * 4
    assert got["odd.json"].collected_at is None and got["odd.json"].visits == 0

    reports = spark.createDataFrame(
        [
            ("REF:StopPoint:Q:1:", 200, 3, True, first.source_file, None, "2026-01-05T08:01:02+00:00"),
            ("a", None, 0, False, None, "timeout", "2026-01-05T08:01:03+00:00"),
            ("b", None, 0, False, None, "refused", "2026-01-05T08:01:04+00:00"),
            ("c", 200, 1, True, "lost.json", None, "2026-01-05T08:01:05+00:00"),
        ],
        schemas.COLLECTION_REPORT,
    )
    joined = audit_with_reports(audit, reports).select("source_file", "visits", "reported_passages", "error")
    assert sorted(rows_of(joined), key=repr) == sorted(
        [
            (first.source_file, 7, 3, None),
            ("snapshot_x_20260105_080103.json", 0, None, None),
            ("snapshot_x_20260105_080104.json", 0, None, None),
            ("odd.json", 0, None, None),
            ("lost.json", None, 1, None),
            (None, None, 0, "timeout"),
            (None, None, 0, "refused"),
        ],
        key=repr,
    )


def passages(spark, *rows):
    """(monitoring_ref, seconds after midnight or None, departure_status, arrival_status[, line_ref])"""
    out = []
    for ref, seconds, departure, arrival, *line in rows:
        ts = None if seconds is None else DAY + dt.timedelta(seconds=seconds)
        text = None if ts is None else ts.isoformat()
        line_ref = line[0] if line else "X:C1"
        out.append(("f", "r", None, ref, line_ref, "C1", "La Gare", text, ts, departure, arrival))
    return spark.createDataFrame(out, schemas.PASSAGES)


def schedule(spark, *times):
    return spark.createDataFrame([("C1", None, f"t{t}", "la-gare ", t) for t in times], schemas.SCHEDULE)


def judged(spark, observed, planned, config=MatchConfig()):
    return {
        (r.monitoring_ref, r.expected_departure_time): r
        for r in matching.judge(matching.match_passages(observed, planned, config), config).collect()
    }


def test_delay_gap_and_threshold(spark):
    observed = passages(spark, ("a", 36_299, None, None), ("b", 36_300, "x", "y"), ("c", 35_700, "x", "y"))
    found = {key[0]: row for key, row in judged(spark, observed, schedule(spark, "10:00:00")).items()}
    assert [(found[k].delay_minutes, found[k].match_gap_minutes, found[k].is_delayed) for k in "abc"] == [
        (4.98, 4.98, False),
        (5.0, 5.0, True),
        (-5.0, 5.0, False),
    ]
    assert [(found[k].disruption_reason, found[k].is_disrupted, found[k].is_cancelled) for k in "abc"] == [
        ("normal", False, None),
        ("delay", True, False),
        ("normal", False, False),
    ]


def test_tolerance_day_line_and_unusable_rows(spark):
    late_night = 3 * 3_600 + 50 * 60
    observed = passages(
        spark, ("edge", 40_000, None, None), ("night", late_night, None, None), ("none", None, "Cancelled", None)
    )
    at = lambda seconds: f"{seconds // 3600:02}:{seconds // 60 % 60:02}:{seconds % 60:02}"
    refs = lambda *times: {key[0] for key in judged(spark, observed, schedule(spark, *times))}
    assert refs(at(47_200), "03:55:00") == {"edge"}
    assert refs(at(47_201), "03:55:00", "7:05", None) == set()
    assert refs("27:55:00") == {"night"}
    night = judged(spark, observed, schedule(spark, "27:55:00"))
    assert [row.delay_minutes for row in night.values()] == [-5.0]


@pytest.mark.parametrize("windowed", [False, True])
def test_equal_distance_takes_the_earlier_departure(spark, windowed):
    match = matching.match_passages_windowed if windowed else matching.match_passages
    found = match(passages(spark, ("a", 36_300, None, None)), schedule(spark, "10:10:00", "10:00:00"))
    assert [(r.departure_time, r.expected_seconds - r.planned_seconds) for r in found.collect()] == [("10:00:00", 300)]


@pytest.mark.parametrize("windowed", [False, True])
def test_one_row_per_observation_with_the_gravest_report(spark, windowed):
    match = matching.match_passages_windowed if windowed else matching.match_passages
    observed = passages(
        spark,
        ("a", 36_000, "onTime", "onTime", "X:C1"),
        ("a", 36_000, "noReport", "onTime", "Y:C1"),
        ("a", 36_000, "Cancelled", None, "Z:C1"),
        ("b", 36_000, "onTime", "onTime", "X:C1"),
        ("b", 36_000, None, "NoReport", "Y:C1"),
    )
    found = match(observed, schedule(spark, "10:00:00"))
    got = {r.monitoring_ref: (r.is_cancelled, r.is_unreported) for r in found.collect()}
    assert got == {"a": (True, None), "b": (None, True)}
    assert found.count() == 2


def test_collapsed_whitespace_changes_the_match(spark):
    observed = passages(spark, ("a", 36_000, None, None)).withColumn("stop_point_name", F.lit("La - Gare"))
    planned = schedule(spark, "10:00:00")
    assert judged(spark, observed, planned) == {}
    assert len(judged(spark, observed, planned, MatchConfig(collapse_whitespace=True)).values()) == 1


def test_stored_spans_carry_their_parameters(spark, tmp_path):
    path = str(tmp_path / "spans")
    made = MatchConfig(tolerance_seconds=600, bucket_seconds=77)
    matching.departure_spans(schedule(spark, "10:00:00"), made).write.parquet(path)
    observed, spans = passages(spark, ("a", 36_300, None, None)), spark.read.parquet(path)
    # The bucket width of the config does not matter, that of the spans does.
    assert matching.match_to_spans(observed, spans, MatchConfig(tolerance_seconds=600)).count() == 1
    others = (
        MatchConfig(),
        MatchConfig(tolerance_seconds=600, rollover_hour=3),
        MatchConfig(tolerance_seconds=600, collapse_whitespace=True),
    )
    for other in others:
        with pytest.raises(ValueError, match="another"):
            matching.match_to_spans(observed, spans, other)


def test_scan_filters_are_pushed(spark, tmp_path):
    passages(spark, ("a", 36_000, None, None)).write.parquet(str(tmp_path / "p"))
    schedule(spark, "10:00:00").write.parquet(str(tmp_path / "s"))
    found = matching.match_passages(spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "s")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for column in ("line_code", "stop_point_name", "expected_departure_ts", "stop_name", "departure_time"):
        assert f"IsNotNull({column})" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert "SortAggregate" not in plan


MATCHED_ROWS = [
    # line, short name, stop, delay, delayed, cancelled, disrupted, reason
    ("C1", "A", "S", 0.0, False, False, False, "normal"),
    ("C1", "A", "S", 6.0, True, None, True, "delay"),
    ("C1", "A", "T", 1.01, False, None, False, "normal"),
    ("C1", None, "T", -2.5, False, True, True, "cancelled_service"),
    ("C2", "C2", "T", 0.5, False, True, True, "cancelled_service"),
]


def matched(spark, rows=MATCHED_ROWS):
    layout = (
        "line_code string, route_short_name string, stop_point_name string, delay_minutes double, "
        "is_delayed boolean, is_cancelled boolean, is_disrupted boolean, disruption_reason string"
    )
    return spark.createDataFrame(rows, layout).withColumn("expected_departure_time", F.lit("t"))


def test_indicators(spark):
    figures = indicators.rollup(matched(spark))
    assert rows_of(indicators.line_performance(figures)) == sorted(
        [("C1", "A", 3, 2.34, 33.33, 33.33), ("C1", None, 1, -2.5, 0.0, 100.0), ("C2", "C2", 1, 0.5, 0.0, 100.0)],
        key=repr,
    )
    assert rows_of(indicators.stop_performance(figures)) == [("S", 2, 3.0, 50.0), ("T", 3, -0.33, 66.67)]
    assert rows_of(indicators.disruption_reasons(figures)) == [("cancelled_service", 2), ("delay", 1), ("normal", 2)]
    assert rows_of(indicators.network_overview(figures)) == [(5, 3, 2, 1.0)]
    assert rows_of(indicators.network_kpis(figures)) == [(5, 2, 2, 1, 3, 2, 1.0, 20.0, 60.0, 40.0)]
    assert rows_of(ranking.top_reasons(figures)) == [
        ("cancelled_service", 2, "Service annule", 66.67),
        ("delay", 1, "Retard", 33.33),
    ]


def test_indicators_without_rows(spark):
    figures = indicators.rollup(matched(spark, []))
    assert rows_of(indicators.network_overview(figures)) == [(0, None, None, None)]
    assert rows_of(indicators.network_kpis(figures)) == [(0, 0, 0, None, None, None, None, 0.0, 0.0, 0.0)]
    assert rows_of(indicators.line_performance(figures)) == []
    assert rows_of(ranking.top_reasons(figures)) == []


def test_rollup_is_one_hash_aggregate(spark):
    plan = indicators.rollup(matched(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_top_preferred_and_fallback(spark):
    layout = schemas.STOP_PERFORMANCE
    some = [("a", 1, 1.0, 50.0), ("b", 9, 1.0, 0.0), ("c", 2, 1.0, 50.0), ("d", 2, None, 50.0), ("e", 1, 1.0, None)]
    top = ranking.top_stops(spark.createDataFrame(some, layout))
    assert [r.stop_point_name for r in top.collect()] == ["c", "d", "a"]
    none = [("a", 1, 1.0, 0.0), ("b", 9, 1.0, 0.0), ("c", 9, 2.0, None)]
    top = ranking.top_stops(spark.createDataFrame(none, layout), k=2)
    assert [r.stop_point_name for r in top.collect()] == ["c", "b"]
    many = [(f"s{i:02}", i, 0.0, 10.0) for i in range(20)] + [("busy", 999, 0.0, 0.0)]
    top = ranking.top_stops(spark.createDataFrame(many, layout))
    assert [r.observations for r in top.collect()] == [19, 18, 17, 16, 15, 14]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_worst_samples_and_charts(spark):
    samples = ranking.worst_samples(matched(spark)).collect()
    assert [(r.line_code, r.delay_minutes, r.disruption_reason) for r in samples] == [
        ("C1", 6.0, "Retard"),
        ("C2", 0.5, "Service annule"),
        ("C1", -2.5, "Service annule"),
    ]
    figures = indicators.rollup(matched(spark))
    charts = ranking.chart_series(
        ranking.top_lines(indicators.line_performance(figures)),
        ranking.top_stops(indicators.stop_performance(figures)).withColumn("stop_point_name", F.lit(None).cast("string")),
        ranking.top_reasons(figures).withColumn("events", F.lit(None).cast("bigint")),
    )
    assert rows_of(charts) == sorted(
        [
            ("top_lines", "C1", 100.0),
            ("top_lines", "C2", 100.0),
            ("top_lines", "C1 (A)", 33.33),
            ("top_stops", "inconnu", 66.67),
            ("top_stops", "inconnu", 50.0),
            ("disruption_reasons", "Service annule", 0.0),
            ("disruption_reasons", "Retard", 0.0),
        ],
        key=repr,
    )

"""Readers, writers, catalog, streaming and the pipeline, through files."""

import json
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_operators import schedule, visit

from punctuality import MatchConfig, schemas
from punctuality.__main__ import arguments, run
from punctuality.operators import indicators, matching
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.plans import pipeline
from punctuality.plans.files import write_files
from punctuality.sources import catalog, scratch, sinks, snapshots, tables
from punctuality.streaming import match_arrivals, read_matches, read_passages, read_rollups


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def snapshot(folder, name, *visits):
    document = {"Siri": {"ServiceDelivery": {"StopMonitoringDelivery": [{"MonitoredStopVisit": list(visits)}]}}}
    return write(folder / name, json.dumps(document, indent=2))


def test_csv_goes_by_name_and_stays_text(spark, tmp_path):
    write(tmp_path / "routes.txt", "extra,route_short_name,route_id\n1,007,NET:C1\n2,,R2\n")
    routes = tables.read_csv(spark, str(tmp_path / "routes.txt"))
    assert rows_of(tables.keep_present(routes, ["route_id", "absent", "route_short_name"])) == [
        ("NET:C1", "007"),
        ("R2", None),
    ]
    with pytest.raises(ValueError, match="absent"):
        tables.keep_present(routes, ["route_id"], required=["absent"])


def test_snapshots_ignore_reports_and_broken_files(spark, tmp_path):
    snapshot(tmp_path, "snapshot_a_20260105_080000.json", visit(), visit(names=["Other"]))
    write(tmp_path / "snapshot_b_20260105_080000.json", "{ not json")
    write(tmp_path / "snapshot_c_20260105_080000.json", '{"Siri": {}}')
    write(
        tmp_path / "collection_report_20260105_080000.json",
        json.dumps([{"monitoring_ref": "a", "ok": True, "nb_passages": 2}, {"monitoring_ref": "b", "ok": False}]),
    )
    found = build_passages(flatten_snapshots(snapshots.read_snapshots(spark, str(tmp_path))))
    name = "snapshot_a_20260105_080000.json"
    assert rows_of(found.select("source_file", "stop_point_name")) == [(name, "Gare"), (name, "Other")]
    reports = snapshots.read_collection_reports(spark, str(tmp_path))
    assert rows_of(reports.select("monitoring_ref", "ok", "nb_passages")) == [("a", True, 2), ("b", False, None)]


def test_no_snapshots_give_no_passages(spark, tmp_path):
    write(tmp_path / "collection_report_20260105_080000.json", "[]")
    found = build_passages(flatten_snapshots(snapshots.read_snapshots(spark, str(tmp_path))))
    assert found.count() == 0


def test_written_snapshots_read_back(spark, tmp_path):
    rows = [(f"snapshot_x_2026010{i}_000000.json", json.dumps({"Siri": {}, "n": "é"})) for i in range(1, 6)]
    folder = str(tmp_path / "out")
    write_files(spark.createDataFrame(rows, "source_file string, document string"), folder)
    assert sorted(os.listdir(folder)) == [name for name, _ in rows]
    back = snapshots.read_snapshots(spark, folder)
    assert rows_of(back.select("source_file")) == [(name,) for name, _ in rows]


def test_parquet_sink_counts_and_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n int, day string")
    assert sinks.write_parquet(rows, path, ["day"]) == 3
    assert sinks.write_parquet(rows.filter("n = 3").withColumn("n", F.lit(9)), path, ["day"]) == 1
    assert rows_of(spark.read.parquet(path)) == [(1, "a"), (2, "a"), (9, "b")]
    assert sinks.write_parquet(rows.limit(0), str(tmp_path / "none")) == 0


def test_quoted_csv_round_trip(spark, tmp_path):
    rows = [('Gare "Nord", quai', "1"), ("a\\b", "2"), ('"', "3"), (" x ", "4")]
    sinks.write_csv(spark.createDataFrame(rows, "stop_name string, stop_id string"), str(tmp_path / "t"))
    assert rows_of(tables.read_csv(spark, str(tmp_path / "t"))) == sorted(rows, key=repr)


def test_report_export(spark, tmp_path):
    rows = spark.createDataFrame([("x ", 1.5, None)], "b string, a double, c string")
    path = tmp_path / "report.csv"
    for frame, text in ((rows, "b,a,c\nx ,1.5,\n"), (rows.filter("a > 9"), "")):
        sinks.export_report(frame, str(path))
        files = list(path.glob("part-*"))
        assert len(files) == 1 and files[0].read_text() == text


def test_clean_csv(spark, tmp_path):
    good = write(tmp_path / "good.txt", '" a ,b", c,d.e \n1,"x ""y"", z",\n,,\n"","",""\n\n,2,\n')
    outcome = sinks.clean_feed(
        spark, {str(tmp_path / "absent.txt"): str(tmp_path / "o1"), good: str(tmp_path / "clean.csv")}
    )
    assert outcome[good] is None and "absent.txt" in outcome[str(tmp_path / "absent.txt")]
    back = tables.read_csv(spark, str(tmp_path / "clean.csv"))
    assert back.columns == ["a ,b", "c", "d.e"]
    assert rows_of(back) == sorted([("1", 'x "y", z', None), (None, "2", None)], key=repr)


def test_scratch_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.new_folder(spark, "x"), scratch.new_folder(spark, "x")
    assert one.startswith(shared + "/") and one != two


def installation(tmp_path):
    raw = tmp_path / "raw"
    write(raw / "gtfs/routes.txt", "route_id,route_short_name\nNET:C1,A\n")
    write(raw / "gtfs/trips.txt", "route_id,service,trip_id\nNET:C1,x,t1\nNET:C1,x,t2\n")
    write(raw / "gtfs/stops.txt", "stop_id,stop_name\ns1,GARE\n")
    write(raw / "gtfs/stop_times.txt", "trip_id,departure_time,stop_id\nt1,08:00:00,s1\nt2,08:20:00,s1\n")
    realtime = raw / "realtime"
    snapshot(realtime, "snapshot_a_20260105_080000.json", visit(), visit(expected="2026-01-05T08:06:00"))
    snapshot(realtime, "snapshot_b_20260105_080500.json", visit(departure="Cancelled"), visit(expected=None))
    return pipeline.Layout(str(tmp_path))


def test_pipeline_end_to_end(spark, tmp_path):
    at = installation(tmp_path)
    rows = pipeline.run_all(spark, at)
    assert rows == {
        "schedule": 2,
        "spans": spark.read.parquet(at["spans"]).count(),
        "passages": 4,
        "matched": 3,
        "rollup": 3,
        "line_performance": 1,
        "stop_performance": 1,
        "disruption_reasons": 3,
        "network_overview": 1,
    }
    assert rows_of(spark.read.parquet(at["network_overview"])) == [(3, 2, 1, 2.0)]
    matched = spark.read.parquet(at["matched"])
    assert matched.columns == schemas.names(schemas.MATCHED)
    exported = {name: tables.read_csv(spark, f"{at['exports']}/{name}.csv") for name in pipeline.reports(spark, at)}
    assert rows_of(exported["top_lines"]) == [("C1 (A)", "3", "2.0", "33.33", "66.67")]
    assert exported["disruption_reasons"].columns == ["disruption_reason", "events", "motif", "share_pct"]
    assert exported["network_overview"].columns[0] == "total_observations"
    assert exported["sample_disruptions"].count() == 2

    pipeline.publish_catalog(spark, at, "transport", "me", str(tmp_path / "warehouse"))
    pipeline.publish_catalog(spark, at, "transport", "me")
    assert rows_of(catalog.rank_lines(spark, "transport", "me")) == [("C1", "A", 66.67, 2.0)]
    assert rows_of(catalog.rank_stops(spark, "transport", "me")) == [("Gare", 66.67, 2.0)]
    assert rows_of(catalog.list_reasons(spark, "transport", "me")) == [
        ("cancelled_service", 1),
        ("delay", 1),
        ("normal", 1),
    ]
    managed = spark.table("transport.me_matched_observations")
    assert rows_of(managed) == rows_of(matched)
    assert spark.sql("DESCRIBE EXTENDED transport.me_line_performance").filter("data_type = 'orc'").count() == 1


def test_command_line_stages(spark, tmp_path):
    at = installation(tmp_path)
    asked = arguments(["schedule", "clean", "stream", "--root", at.root, "--time-zone", "UTC"])
    assert run(spark, asked)["schedule"] == 2
    assert read_matches(spark, at["arrivals"]).count() == 3
    cleaned = tables.read_csv(spark, f"{at['clean_feed']}/stops.csv")
    assert rows_of(cleaned) == [("s1", "GARE")]


def test_stream_equals_batch_and_restarts_cleanly(spark, tmp_path):
    arriving, output, state = tmp_path / "arriving", str(tmp_path / "out"), str(tmp_path / "state")
    spans = str(tmp_path / "spans")
    matching.departure_spans(schedule(spark, "08:00:00", "08:20:00").withColumn("stop_name", F.lit("gare"))).write.parquet(
        spans
    )
    start = lambda: match_arrivals(spark, str(arriving), spans, output, state, files_per_batch=2).awaitTermination()
    for i in range(3):
        snapshot(arriving, f"snapshot_a_20260105_08000{i}.json", visit(), visit(expected=f"2026-01-05T08:0{i}:30"))
    start()
    snapshot(arriving, "snapshot_a_20260105_080009.json", visit(arrival="cancelled"))
    write(arriving / "collection_report_20260105_080009.json", "[]")
    start()
    start()
    batch = build_passages(flatten_snapshots(snapshots.read_snapshots(spark, str(arriving))))
    expected = matching.judge(matching.match_to_spans(batch, spark.read.parquet(spans)), MatchConfig())
    streamed = read_matches(spark, output)
    assert rows_of(streamed.drop("batch_id", "service_date")) == rows_of(expected)
    assert streamed.count() == 7
    assert {r.service_date for r in streamed.collect()} == {"2026-01-05"}
    assert read_passages(spark, output).count() == batch.count()
    summed = indicators.added(read_rollups(spark, output), *indicators.ROLLUP_KEY)
    assert rows_of(summed) == rows_of(indicators.rollup(expected).select(*summed.columns))

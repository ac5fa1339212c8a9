"""The store of arrivals: damaged files, replays, compaction, samples, daily catalog tables, each file once."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_operators import schedule, visit
from test_sources import installation, snapshot, write

from punctuality import schemas
from punctuality.__main__ import arguments, run
from punctuality.operators import documents, indicators, matching, ranking
from punctuality.operators.audit import audit_snapshots
from punctuality.plans import pipeline
from punctuality.sources import catalog, files, schedules, snapshots, tables
from punctuality.sources.store import DATE, Store
from punctuality.streaming import (
    collect_arrivals,
    compact,
    match_arrivals,
    match_waiting,
    read_documents,
    read_matches,
    read_passages,
    read_quarantine,
    read_rollups,
    read_samples,
    replay_mended,
)
from punctuality.streaming import match

WHOLE = json.dumps({"Siri": {"ServiceDelivery": {"StopMonitoringDelivery": [{"MonitoredStopVisit": [visit()]}]}}})
TEXTS = [
    (WHOLE, "ok"),
    (json.dumps(json.loads(WHOLE), indent=2) + "\n", "ok"),
    (WHOLE[: len(WHOLE) // 2], "unreadable"),
    (WHOLE + " " + WHOLE, "unreadable"),
    (f"{WHOLE},{WHOLE}", "unreadable"),
    ("HTTP 502 Bad Gateway", "unreadable"),
    (WHOLE.replace('"', "'"), "unreadable"),
    (f"[{WHOLE}]", "not_an_object"),
    ("[1, 2]", "not_an_object"),
    ("null", "not_an_object"),
    ("3", "not_an_object"),
    ("", "empty"),
    (" \r\n\t", "empty"),
    (None, "empty"),
    ("{}", "without_deliveries"),
    ('{"Siri": null}', "without_deliveries"),
    ('{"Siri": {"ServiceDelivery": {}}}', "without_deliveries"),
    ('{"Siri": {"ServiceDelivery": {"StopMonitoringDelivery": {"a": 1}}}}', "partial"),
]


def test_what_texts_turn_out_to_be(spark):
    texts = spark.createDataFrame([(n, text, "x") for n, (text, _) in enumerate(TEXTS)], "n int, document string, status_of string")
    found = {r.n: r for r in documents.examine(texts).collect()}
    assert [found[n].status for n in range(len(TEXTS))] == [status for _, status in TEXTS]
    assert all((r.Siri is None) == (r.status not in ("ok", "partial") and r.n != 16) for r in found.values())
    assert documents.examine(texts.limit(0)).collect() == []
    plan = documents.examine(texts).select("status", "Siri")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_audit_tells_damaged_from_empty(spark, tmp_path):
    snapshot(tmp_path, "snapshot_a_20260105_080000.json", visit())
    snapshot(tmp_path, "snapshot_b_20260105_080000.json")
    write(tmp_path / "snapshot_c_20260105_080000.json", WHOLE[:-20])
    found = audit_snapshots(snapshots.read_snapshots(spark, str(tmp_path)))
    assert [(r.source_file[9], r.status, r.visits) for r in found.orderBy("source_file").collect()] == [
        ("a", "ok", 1),
        ("b", "ok", 0),
        ("c", "unreadable", 0),
    ]


@pytest.fixture
def spans(spark, tmp_path):
    path = str(tmp_path / "spans")
    planned = schedule(spark, "08:00:00", "08:20:00").withColumn("stop_name", F.lit("gare"))
    matching.departure_spans(planned).write.parquet(path)
    return path


def test_quarantine_and_replay(spark, tmp_path, spans):
    arriving, output, state = tmp_path / "arriving", str(tmp_path / "out"), str(tmp_path / "state")
    good, cut, listed = (f"snapshot_{x}_20260105_080000.json" for x in "abc")
    snapshot(arriving, good, visit())
    write(arriving / cut, WHOLE[:-9])
    write(arriving / listed, f"[{WHOLE}]")
    match_arrivals(spark, str(arriving), spans, output, state).awaitTermination()
    held = read_quarantine(spark, output)
    assert rows_of(held.select("source_file", "status", "document")) == [(cut, "unreadable", WHOLE[:-9]), (listed, "not_an_object", f"[{WHOLE}]")]
    assert rows_of(read_matches(spark, output).select("source_file")) == [(good,)]

    mended = tmp_path / "mended"
    write(mended / cut, WHOLE)
    write(mended / listed, f"[{WHOLE}")  # still damaged
    write(mended / good, WHOLE)  # was never damaged
    assert replay_mended(spark, str(mended), output) == 1
    assert replay_mended(spark, str(mended), output) == 0
    store = Store(spark, output)
    assert len(match_waiting(store, spans)) == 1 and match_waiting(store, spans) == []
    assert rows_of(read_matches(spark, output).select("source_file")) == [(good,), (cut,)]
    assert rows_of(read_quarantine(spark, output).select("source_file")) == [(listed,)]
    # The ledger keeps both forms, and compaction changes nothing of this.
    compact(store, 1)
    assert rows_of(read_documents(spark, output).select("source_file", "status")) == [
        (good, "ok"), (cut, "ok"), (cut, "unreadable"), (listed, "not_an_object")
    ]
    assert rows_of(read_quarantine(spark, output).select("source_file")) == [(listed,)]
    assert replay_mended(spark, str(tmp_path / "mended"), output) == 0


def test_nothing_arrives(spark, tmp_path, spans):
    arriving, output = tmp_path / "arriving", str(tmp_path / "out")
    write(arriving / "collection_report_20260105_080000.json", "[]")
    match_arrivals(spark, str(arriving), spans, output, str(tmp_path / "state")).awaitTermination()
    for read in (read_documents, read_quarantine, read_passages, read_matches, read_rollups, read_samples):
        assert read(spark, output).collect() == []
    assert compact(Store(spark, output)) == {name: [] for name in ("passages", "matched", "rollup", "samples", "documents")}


def test_a_batch_that_runs_again_counts_once(spark, tmp_path, spans):
    """The checkpoint is lost after the commit, so the stream delivers the same batch again."""
    arriving, output = tmp_path / "arriving", str(tmp_path / "out")
    snapshot(arriving, "snapshot_a_20260105_080000.json", visit(), visit(expected="2026-01-05T08:06:00"))
    for attempt in range(2):
        match_arrivals(spark, str(arriving), spans, output, str(tmp_path / f"state{attempt}")).awaitTermination()
    assert read_matches(spark, output).count() == 2
    assert {part.dataset for part in Store(spark, output).manifest().parts} == {"documents", "passages", "matched", "rollup", "samples"}


def test_compaction_bounds_files_and_keeps_figures(spark, tmp_path, spans):
    arriving, output, state = tmp_path / "arriving", str(tmp_path / "out"), str(tmp_path / "state")
    store = Store(spark, output)
    for n in range(6):
        snapshot(arriving, f"snapshot_a_2026010{5 + n % 2}_08000{n}.json", *[visit(expected=f"2026-01-0{5 + n % 2}T08:{n:02d}:{i:02d}") for i in range(4)])
        match_arrivals(spark, str(arriving), spans, output, state).awaitTermination()
        compact(store, 2)
        by_date = {}
        for part in store.manifest().of("rollup"):
            by_date[part.date] = by_date.get(part.date, 0) + 1
        assert max(by_date.values()) <= 2
    matched = read_matches(spark, output)
    expected = rows_of(indicators.rollup(matched).select(*schemas.names(schemas.ROLLUP)))
    key = (*indicators.ROLLUP_KEY,)
    assert rows_of(indicators.added(read_rollups(spark, output), *key)) == expected
    samples = read_samples(spark, output)
    assert rows_of(ranking.worst_samples(samples)) == rows_of(ranking.worst_samples(matched))
    assert matched.count() == 24 and samples.count() <= 2 * 2 * ranking.TOP_SAMPLES
    read = ranking.worst_samples(samples).inputFiles()
    assert read and all("/samples/" in name for name in read)
    # Folders that no reader sees go, all others stay.
    assert store.clean() > 0 and store.clean() == 0
    assert rows_of(indicators.added(read_rollups(spark, output), *key)) == expected
    assert read_passages(spark, output).count() == 24


def test_samples_of_samples(spark):
    rows = [("d1", f"l{n % 3}", float(n % 7), n % 2 == 0) for n in range(60)] + [("d2", "l", None, True), ("d2", "l", 1.0, True), (None, "l", 2.0, True)]
    matched = spark.createDataFrame(rows, "service_date string, line_code string, delay_minutes double, is_disrupted boolean")
    matched = matched.withColumns({c: F.lit("x") for c in ("stop_point_name", "expected_departure_time", "disruption_reason")})
    whole = rows_of(ranking.worst_samples(matched, 5))
    half = F.col("delay_minutes") % 2 == 0
    parts = [ranking.sample_candidates(matched.filter(F.coalesce(half, F.lit(False)) == side), DATE, 5) for side in (True, False)]
    merged = ranking.sample_candidates(parts[0].unionByName(parts[1]), DATE, 5)
    assert rows_of(ranking.worst_samples(merged, 5)) == whole and merged.count() == 5 + 2 + 1
    assert ranking.sample_candidates(matched.limit(0), DATE).collect() == []
    assert "WindowGroupLimit" in merged._jdf.queryExecution().executedPlan().toString()


def test_manifest_refuses_a_second_writer(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    seen = store.manifest()
    rows = spark.createDataFrame([(1, "2026-01-05"), (2, None)], f"n int, {DATE} string")
    parts = store.write("numbers", "one", rows)
    assert sorted((p.date or "", p.rows) for p in parts) == [("", 1), ("2026-01-05", 1)]
    assert store.read("numbers", "n int").collect() == []  # written, but not committed
    store.commit(seen, parts, {"by": "one"})
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(seen, [])
    assert store.manifest().notes == {"by": "one"}
    assert rows_of(store.read("numbers", "n int")) == [(1, "2026-01-05"), (2, None)]
    assert store.manifest(0).parts == () and files.listed(spark, str(tmp_path / "absent")) == []


def test_files_are_opened_once(spark, tmp_path):
    at = installation(tmp_path)
    first = pipeline.make_passages(spark, at)["passages"]
    for name in files.listed(spark, at["snapshots"]):  # had the next run opened them, it would lose their visits
        write(tmp_path / "raw/realtime" / name, "damaged since")
    snapshot(tmp_path / "raw/realtime", "snapshot_c_20260105_090000.json", visit())
    assert first == 4 and pipeline.make_passages(spark, at) == {"passages": 5}
    # The stream goes on from there: it matches what the batch has taken and opens no file.
    pipeline.make_schedule(spark, at)
    match_arrivals(spark, at["snapshots"], at["spans"], at["arrivals"], at["arrivals_state"]).awaitTermination()
    match_waiting(Store(spark, at["arrivals"]), at["spans"])
    assert read_passages(spark, at["arrivals"]).count() == 5 and read_matches(spark, at["arrivals"]).count() == 4


def test_small_documents_become_few_files(spark, tmp_path):
    arriving, output = tmp_path / "arriving", str(tmp_path / "out")
    for n in range(40):
        snapshot(arriving, f"snapshot_a_20260105_0800{n:02d}.json", visit())
    collect_arrivals(spark, str(arriving), output, str(tmp_path / "state")).awaitTermination()
    (part,) = Store(spark, output).manifest().of("documents")
    held = [name for name in files.listed(spark, f"{output}/{part.folder}") if name.startswith("part-")]
    assert part.rows == 40 and len(held) == 1
    assert read_documents(spark, output).filter("document IS NOT NULL").count() == 0


def test_streamed_results_to_the_end(spark, tmp_path):
    at = installation(tmp_path)
    args = ["--root", at.root, "--time-zone", "UTC", "--streamed", "--database", "streamed", "--prefix", "me"]
    run(spark, arguments(["schedule", "stream", "indicators", "exports", "catalog", *args]))
    samples = tables.read_csv(spark, f"{at['exports']}/sample_disruptions.csv")
    assert samples.count() == 2 and not files.listed(spark, at["matched"])
    managed = "streamed.me_daily_observations"
    assert rows_of(spark.table(managed).drop(DATE)) == rows_of(read_matches(spark, at["arrivals"]).drop(DATE))
    assert catalog.publish_days(Store(spark, at["arrivals"]), "matched", "streamed", "me") == []

    # A new day is added, the old one is not touched; a second batch and a merge of a day rewrite that day.
    before = [row.part for row in spark.table(managed).select(F.col("_metadata.file_name").alias("part")).distinct().collect()]
    snapshot(tmp_path / "raw/realtime", "snapshot_a_20260106_080000.json", visit(expected="2026-01-06T08:01:00"))
    run(spark, arguments(["stream", *args]))
    store = Store(spark, at["arrivals"])
    assert catalog.publish_days(store, "matched", "streamed", "me") == ["2026-01-06"]
    after = spark.table(managed).filter(f"{DATE} = '2026-01-05'").select(F.col("_metadata.file_name").alias("part")).distinct()
    assert [row.part for row in after.collect()] == before
    snapshot(tmp_path / "raw/realtime", "snapshot_a_20260106_080500.json", visit(expected="2026-01-06T08:02:00"))
    run(spark, arguments(["stream", "compact", *args]))
    compact(store, 1)
    assert catalog.publish_days(store, "matched", "streamed", "me") == ["2026-01-06"]
    assert rows_of(spark.table(managed).drop(DATE)) == rows_of(read_matches(spark, at["arrivals"]).drop(DATE))
    assert spark.sql("SHOW PARTITIONS streamed.me_daily_observations_ext").count() == 2


def test_a_backlog_is_matched_in_one_pass(spark, tmp_path, spans, monkeypatch):
    """Files of several batches are matched together: the spans are opened once, and a date has one part of matches."""
    opened = []
    monkeypatch.setattr(match, "read_loads", lambda *args: opened.append(args) or schedules.read_loads(*args))
    arriving, output = tmp_path / "arriving", str(tmp_path / "out")
    for n in range(5):
        snapshot(arriving, f"snapshot_a_20260105_08000{n}.json", visit(expected=f"2026-01-05T08:0{n}:30"))
    match_arrivals(spark, str(arriving), spans, output, str(tmp_path / "state"), files_per_batch=2).awaitTermination()
    store = Store(spark, output)
    assert len({part.name for part in store.manifest().of("documents")}) == 3 and len(opened) == 1
    assert [part.rows for part in store.manifest().of("matched")] == [5] and read_passages(spark, output).count() == 5
    assert match_waiting(store, spans) == []


def test_a_match_that_fails_is_raised_and_waits(spark, tmp_path, spans):
    arriving, output, state = tmp_path / "arriving", str(tmp_path / "out"), str(tmp_path / "state")
    snapshot(arriving, "snapshot_a_20260105_080000.json", visit())
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        match_arrivals(spark, str(arriving), str(tmp_path / "absent"), output, state).awaitTermination()
    assert read_documents(spark, output).count() == 1 and read_matches(spark, output).collect() == []
    match_arrivals(spark, str(arriving), spans, output, state).awaitTermination()
    assert read_matches(spark, output).count() == 1


def test_files_of_a_batch_are_listed_by_few_tasks(spark, tmp_path):
    before = spark.conf.get(snapshots.LISTING)
    try:
        spark.conf.set(snapshots.LISTING, "10000")
        snapshots.follow_texts(spark, str(tmp_path))
        assert int(spark.conf.get(snapshots.LISTING)) == snapshots.LISTING_TASKS
        spark.conf.set(snapshots.LISTING, "8")
        snapshots.follow_reports(spark, str(tmp_path))
        assert spark.conf.get(snapshots.LISTING) == "8"
    finally:
        spark.conf.set(snapshots.LISTING, before)

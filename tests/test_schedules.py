"""Loads of the schedule by service date, and matches brought up to date after a load."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_operators import schedule, visit
from test_sources import installation, snapshot

from punctuality import MatchConfig, schemas
from punctuality.__main__ import arguments, run
from punctuality.operators import indicators, matching, ranking
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.operators.schedule import build_schedule
from punctuality.plans import pipeline, queries
from punctuality.sources.schedules import last_load, load_schedule, read_loads
from punctuality.sources.snapshots import read_snapshots
from punctuality.sources.store import DATE, Store
from punctuality.streaming import compact, match_arrivals, read_matches, read_passages, read_rollups, read_samples, rematch


def planned(spark, *times, line="C1"):
    return schedule(spark, *times).withColumns({"stop_name": F.lit("gare"), "line_code": F.lit(line)})


def test_loads_by_date(spark, tmp_path):
    path = str(tmp_path / "gtfs" / "spans")
    load_schedule(planned(spark, "08:00:00"), path, "2026-02-01")
    load_schedule(planned(spark, "08:00:00"), path)
    load_schedule(planned(spark, "08:00:00", "08:30:00"), path, "2026-02-01")
    load_schedule(planned(spark, "08:00:00").limit(0), path, "2026-03-01")
    facts = lambda loads: [(load.valid_from, load.until, load.spans.select("trip_id", "departure_time").distinct().count()) for load in loads]
    assert facts(read_loads(spark, path)) == [(None, "2026-02-01", 1), ("2026-02-01", "2026-03-01", 2), ("2026-03-01", None, 0)]
    assert facts(read_loads(spark, path, "2026-02-03", "2026-02-04")) == [("2026-02-01", "2026-03-01", 2)]
    assert facts(read_loads(spark, path, "2026-01-31", "2026-02-01")) == [(None, "2026-02-01", 1), ("2026-02-01", "2026-03-01", 2)]
    assert facts(read_loads(spark, path, upto="load-000000000001")) == [("2026-02-01", None, 1)]
    assert facts(read_loads(spark, path, "2025-01-01", "2025-01-02", "load-000000000001")) == [("2026-02-01", None, 1)]
    assert last_load(spark, path) == "load-000000000004" and last_load(spark, str(tmp_path / "other" / "spans")) is None


def test_passages_go_by_the_load_of_their_date(spark, tmp_path):
    days = ["2026-01-31T08:01:00", "2026-02-01T03:00:00", "2026-02-01T08:01:00", "2026-02-02T02:00:00"]
    snapshot(tmp_path, "snapshot_a_20260105_080000.json", *[visit(expected=day) for day in days])
    passages = build_passages(flatten_snapshots(read_snapshots(spark, str(tmp_path))))
    spans = lambda *times: matching.departure_spans(planned(spark, *times))
    early, late = spans("08:00:00", "26:55:00"), spans("08:02:00", "25:59:00")
    times = lambda loads: {r.expected_departure_time: r.departure_time for r in matching.match_to_loads(passages, loads).collect()}
    # 03:00 of the first of February still belongs to the service day before.
    assert times([("2026-02-01", late), (None, early)]) == dict(zip(days, ["08:00:00", "26:55:00", "08:02:00", "25:59:00"], strict=True))
    assert times([("2026-02-01", late)]) == dict(zip(days[2:], ["08:02:00", "25:59:00"], strict=True))
    whole = matching.match_to_loads(passages, [(None, early)])
    assert rows_of(whole) == rows_of(matching.match_to_spans(passages, early))
    for loads in ([], [(None, early), (None, late)], [(None, early), ("2026-02-01", matching.departure_spans(planned(spark, "08:00:00"), MatchConfig(bucket_seconds=60)))]):
        with pytest.raises(ValueError):
            matching.match_to_loads(passages, loads)


def test_a_reload_does_not_disturb_readers(spark, tmp_path):
    at = installation(tmp_path)
    pipeline.make_schedule(spark, at)
    (held,) = read_loads(spark, at["spans"])
    expected = rows_of(held.spans)
    for date in (None, "2026-01-06"):
        run(spark, arguments(["schedule", "--root", at.root, *(["--valid-from", date] if date else [])]))
        assert rows_of(held.spans) == expected
    assert [load.valid_from for load in read_loads(spark, at["spans"])] == [None, "2026-01-06"]
    assert rows_of(pipeline.read_loads(spark, at["spans"])[0].spans) == expected


def arrive(arriving, n):
    """A file with three days of two lines, every ten minutes of three hours."""
    for day in (5, 6, 7):
        for line in ("REF:Line::C1:", "REF:Line::C2:"):
            rows = [visit(expected=f"2026-01-0{day}T{8 + n % 3:02d}:{m:02d}:0{n}", line=line) for m in range(0, 60, 10)]
            snapshot(arriving, f"snapshot_{line[-3:-1]}{n}_2026010{day}_080000.json", *rows)


def test_rematch_equals_a_rebuild(spark, tmp_path):
    arriving, output, state = tmp_path / "arriving", str(tmp_path / "out"), str(tmp_path / "state")
    path, store = str(tmp_path / "gtfs" / "spans"), Store(spark, str(tmp_path / "out"))
    both = lambda one, two: planned(spark, *one).unionByName(planned(spark, *two, line="C2"))
    stream = lambda: match_arrivals(spark, str(arriving), path, output, state).awaitTermination()
    load_schedule(both(["08:00:00", "09:00:00", "10:30:00"], ["08:10:00", "10:00:00"]), path)
    arrive(arriving, 0)
    stream()
    arrive(arriving, 1)
    stream()
    assert rematch(store, path) == []
    before = {part for part in store.manifest().parts if part.dataset in ("matched", "samples", "passages")}

    # From the sixth on line C1 has one departure less and one moved; C2 is as before.
    load_schedule(both(["08:05:00", "10:30:00"], ["08:10:00", "10:00:00"]), path, "2026-01-06")
    arrive(arriving, 2)
    stream()
    touched = rematch(store, path)
    assert touched == ["2026-01-06", "2026-01-07"]
    after = {part for part in store.manifest().parts if part.dataset in ("matched", "samples", "passages")}
    assert {part.date for part in before - after} == set(touched) and {part.dataset for part in before - after} == {"matched", "samples"}

    def same_as_rebuilt():
        loads = [(load.valid_from, load.spans) for load in read_loads(spark, path)]
        passages = read_passages(spark, output).drop(DATE)
        expected = matching.judge(matching.match_to_loads(passages, loads))
        assert rows_of(read_matches(spark, output).drop(DATE)) == rows_of(expected)
        figures = read_rollups(spark, output)
        columns = schemas.names(schemas.ROLLUP)
        assert rows_of(indicators.added(figures, *indicators.ROLLUP_KEY).select(columns)) == rows_of(indicators.rollup(expected).select(columns))
        assert rows_of(indicators.network_kpis(figures)) == rows_of(indicators.network_kpis(indicators.rollup(expected)))
        assert rows_of(indicators.disruption_reasons(figures)) == rows_of(indicators.disruption_reasons(indicators.rollup(expected)))
        assert rows_of(ranking.worst_samples(read_samples(spark, output))) == rows_of(ranking.worst_samples(expected))

    same_as_rebuilt()
    assert rematch(store, path) == []
    # Two loads at once: one takes the place of the last, one makes line C2 vanish on the last day alone. Rows of no match remain
    # without any, and a load of nothing takes all matches away.
    load_schedule(both(["08:00:00", "09:00:00", "10:30:00"], ["08:10:00", "10:00:00"]), path, "2026-01-06")
    load_schedule(planned(spark, "08:00:00", "09:00:00", "10:30:00"), path, "2026-01-07")
    assert rematch(store, path) == ["2026-01-06", "2026-01-07"]
    same_as_rebuilt()
    compact(store, 1)
    store.clean()
    same_as_rebuilt()
    load_schedule(planned(spark, "08:00:00").limit(0), path, "2026-01-07")
    assert rematch(store, path) == ["2026-01-07"]
    same_as_rebuilt()


def test_passages_outside_the_change_are_not_read(spark, tmp_path):
    """Dates by folder, lines by the statistics of the files: the plan asks for both."""
    arriving, output = tmp_path / "arriving", str(tmp_path / "out")
    path, store = str(tmp_path / "gtfs" / "spans"), Store(spark, output)
    load_schedule(planned(spark, "08:00:00"), path)
    arrive(arriving, 0)
    early = [visit(expected=f"2026-01-06T07:{m}:00", line="REF:Line::C1:") for m in (30, 50)]
    snapshot(arriving, "snapshot_C1_20260106_070000.json", *early)
    match_arrivals(spark, str(arriving), path, output, str(tmp_path / "state")).awaitTermination()
    (old,) = read_loads(spark, path)
    changed = matching.changed_spans(old.spans, matching.departure_spans(planned(spark, "08:00:00", "08:20:00")))
    inside = [part for part in store.manifest().of("passages") if part.date == "2026-01-06"]
    rows = store.read("passages", schemas.PASSAGES, inside).filter(F.col("line_code").isin("C1"))
    hit = matching.hit_by(rows, changed)
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert all("service_date=2026-01-06" in name for name in hit.inputFiles() if "/passages/" in name)
    assert "EqualTo(line_code,C1)" in plan
    # From the bucket in which the spans of the two departures meet.
    assert {r.expected_departure_time[11:16] for r in hit.collect()} == {"08:00", "08:10", "08:20", "08:30", "08:40", "08:50"}
    assert matching.hit_by(rows, changed, missed=True).count() == 2


def test_distinct_departures_are_told_by_a_sort(spark):
    """Copies of departures go, nulls included, without a hash table of whole rows on either side of an exchange."""
    routes = spark.createDataFrame([("C1", "1"), ("C2", None)], "route_id string, route_short_name string")
    trips = spark.createDataFrame([("C1", "t1"), ("C2", "t2"), ("C2", "t2")], "route_id string, trip_id string")
    stops = spark.createDataFrame([("s", "Gare"), ("p", "Gare")], "stop_id string, stop_name string")
    times = [("t1", "s", "08:00:00"), ("t1", "p", "08:00:00"), ("t1", "s", "09:00:00"), ("t2", "s", None)]
    stop_times = spark.createDataFrame(times, "trip_id string, stop_id string, departure_time string")
    found = build_schedule(routes, trips, stop_times, stops)
    assert rows_of(found.select("line_code", "route_short_name", "trip_id", "stop_name", "departure_time")) == [
        ("C1", "1", "t1", "Gare", "08:00:00"), ("C1", "1", "t1", "Gare", "09:00:00"), ("C2", None, "t2", "Gare", None)
    ]
    assert build_schedule(routes, trips, stop_times, stops, distinct=False).count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "HashAggregate" not in plan


def test_loads_of_one_schedule_join_its_feed_once(spark, tmp_path, monkeypatch):
    """Every load reads stored departures, not the feed tables; the spans of a line and stop lie in one file."""
    tables = {
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name FROM range(25)",
        "orders": "SELECT id AS o_orderkey, id * 7 AS o_custkey FROM range(60)",
        "part": "SELECT id AS p_partkey, concat('stop ', id % 8) AS p_name, 'x' AS p_type FROM range(40)",
        "lineitem": "SELECT id % 60 AS l_orderkey, id % 40 AS l_partkey, CAST(id AS INT) AS l_linenumber FROM range(600)",
        "events": "SELECT id AS event_id, timestamp_ntz'2024-01-10 08:00:00' + make_dt_interval(id % 9, 0, id) AS ts, id AS user_id, 'view' AS event_type FROM range(200)",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    read, paths = [], []

    def load(departures, path, *more):
        read.append(departures.inputFiles())
        paths.append(path)
        return load_schedule(departures, path, *more)

    monkeypatch.setattr(queries.schedules, "load_schedule", load)
    found = queries.schedule_versions(spark, str(tmp_path))
    assert found.count() and len(read) == 3 and all(files and not any(str(tmp_path) in file for file in files) for files in read)
    whole = read_loads(spark, paths[0])[0].spans.withColumn("file", F.input_file_name())
    assert whole.groupBy(*matching.GROUP).agg(F.countDistinct("file").alias("n")).filter("n > 1").isEmpty()

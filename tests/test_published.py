"""Sets of datasets that are published in one step, the audit by day, line breaks in fields."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_operators import visit
from test_sources import installation, snapshot, write

from punctuality.operators.audit import audit_snapshots, audit_with_reports
from punctuality.plans import pipeline
from punctuality.sources import files, sinks, snapshots, tables
from punctuality.sources.publication import Publication
from punctuality.sources.store import DATE, Store
from punctuality.streaming import audit_days, collect_arrivals, collect_reports, compact, read_audit


def test_readers_see_one_set(spark, tmp_path):
    published = Publication(spark, str(tmp_path / "sets"))
    with pytest.raises(FileNotFoundError):
        published.read()
    assert published.rows() == {}
    frame = lambda n: spark.range(n).withColumn("of", F.lit(n))
    makers = lambda n: {"all": lambda made: frame(n), "half": lambda made: made["all"].filter("id % 2 = 0")}
    assert published.publish(makers(4)) == {"all": 4, "half": 2}
    held = published.read()

    def fails(made):
        assert rows_of(published.read()["all"]) == rows_of(frame(4)) and made["all"].count() == 7
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        published.publish({**makers(7), "more": fails})
    assert published.rows() == {"all": 4, "half": 2} and set(published.read()) == {"all", "half"}
    assert published.publish(makers(6)) == {"all": 6, "half": 3}  # over what the failed run has left
    assert rows_of(published.read()["all"]) == rows_of(frame(6))
    assert rows_of(held["half"]) == rows_of(frame(4).filter("id % 2 = 0"))  # who has opened a set keeps it
    assert published.publish(makers(0)) == {"all": 0, "half": 0} and published.read()["half"].columns == ["id", "of"]
    assert published.clean(keep=1) == ["run-000000000001", "run-000000000002"]
    assert published.rows() == {"all": 0, "half": 0} and published.read()["all"].collect() == []


def test_reports_come_from_one_set(spark, tmp_path):
    at = installation(tmp_path)
    pipeline.run_all(spark, at)
    before = {name: rows_of(rows) for name, rows in pipeline.reports(spark, at).items()}
    sinks.write_parquet(spark.createDataFrame([], spark.read.parquet(at["matched"]).schema), at["matched"])
    assert {name: rows_of(rows) for name, rows in pipeline.reports(spark, at).items()} == before
    pipeline.make_indicators(spark, at)
    after = {name: rows_of(rows) for name, rows in pipeline.reports(spark, at).items()}
    assert after["sample_disruptions"] == [] and after["network_overview"][0][0] == 0
    assert Publication(spark, at["published"]).rows()["line_performance"] == 0


def entry(file, ref="Q:1", at="2026-01-05T08:00:00+00:00", **more):
    return {"monitoring_ref": ref, "snapshot_file": file, "collected_at": at, "status_code": 200, "ok": True, "nb_passages": 1} | more


def test_audit_by_day(spark, tmp_path):
    folder, output = tmp_path / "raw", str(tmp_path / "out")
    store, name = Store(spark, output), lambda day, x: f"snapshot_{x}_2026010{day}_080000.json"

    def arrives():
        collect_arrivals(spark, str(folder), output, str(tmp_path / "state")).awaitTermination()
        collect_reports(spark, str(folder), output, str(tmp_path / "reports")).awaitTermination()
        return audit_days(store)

    def equals_batch():
        batch = audit_with_reports(audit_snapshots(snapshots.read_snapshots(spark, str(folder))), snapshots.read_collection_reports(spark, str(folder)))
        assert rows_of(read_audit(spark, output).drop(DATE)) == rows_of(batch)

    assert read_audit(spark, output).collect() == [] and audit_days(store) == []
    snapshot(folder, name(5, "a"), visit())
    write(folder / name(5, "b"), "{ cut")
    snapshot(folder, name(6, "a"), visit(), visit())
    snapshot(folder, "snapshot_odd.json", visit())
    assert arrives() == [None, "2026-01-05", "2026-01-06"]
    equals_batch()
    late = [entry(name(5, "a")), entry(name(5, "lost")), entry("snapshot_odd.json"), entry(None, ok=False, status_code=None, error="HTTP 503", at="2026-01-07T23:59:00+00:00")]
    write(folder / "collection_report_20260107_000000.json", json.dumps(late))
    assert arrives() == [None, "2026-01-05", "2026-01-07"]
    equals_batch()
    assert {r.status for r in read_audit(spark, output).collect()} == {"ok", "unreadable", None}
    # Nothing new, and a merge of parts, change nothing; a report of a day long done does.
    compact(store, 1)
    assert arrives() == []
    write(folder / "collection_report_20260108_000000.json", json.dumps([entry(name(6, "a"))]))
    assert arrives() == ["2026-01-06"]
    equals_batch()
    assert all(files.listed(spark, f"{output}/{part.folder}") for part in store.manifest().of("audit"))


def test_line_breaks_in_fields(spark, tmp_path):
    source = write(tmp_path / "stops.txt", 'stop_id ,stop_name\n1,"Gare\nNord"\n,\n2,"a ""b"", c"\n')
    sinks.clean_csv(spark, source, str(tmp_path / "clean"))
    back = tables.read_csv(spark, str(tmp_path / "clean"), multiLine="true")
    assert back.columns == ["stop_id", "stop_name"] and rows_of(back) == [("1", "Gare\nNord"), ("2", 'a "b", c')]
    sinks.clean_csv(spark, source, str(tmp_path / "split"), multi_line=False)
    assert tables.read_csv(spark, str(tmp_path / "split")).count() == 3

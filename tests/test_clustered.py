"""The match of stored tables: equal rows, no exchange."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_schedules import arrive, planned

from punctuality import MatchConfig
from punctuality.operators import matching
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.sources import catalog, clustered
from punctuality.sources.snapshots import read_snapshots


def test_match_without_exchange(spark, tmp_path):
    catalog.create_database(spark, "clustered", str(tmp_path / "warehouse"))
    arrive(tmp_path / "raw", 0)
    arrive(tmp_path / "raw", 1)
    passages = build_passages(flatten_snapshots(read_snapshots(spark, str(tmp_path / "raw"))))
    spans = matching.departure_spans(planned(spark, "08:00:00", "08:30:00", "09:10:00").unionByName(planned(spark, "08:40:00", line="C2")))
    expected = matching.match_to_spans(passages, spans)
    clustered.save_spans(spans, "clustered.spans", 4)
    clustered.save_observed(passages.unionByName(passages), "clustered.observed", 4)
    found = clustered.match_saved(spark, "clustered.observed", "clustered.spans")
    assert found.columns == expected.columns and rows_of(found) == rows_of(expected) and found.count() > 20
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan

    # A later load of spans takes the place of the first; the passages stay as they lie.
    later = matching.departure_spans(planned(spark, "09:00:00"))
    clustered.save_spans(later, "clustered.spans", 4)
    again = clustered.match_saved(spark, "clustered.observed", "clustered.spans")
    assert rows_of(again) == rows_of(matching.match_to_spans(passages, later))
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_tables_of_different_parameters_are_refused(spark, tmp_path):
    catalog.create_database(spark, "refused", str(tmp_path / "warehouse"))
    arrive(tmp_path / "raw", 0)
    passages = build_passages(flatten_snapshots(read_snapshots(spark, str(tmp_path / "raw"))))
    clustered.save_observed(passages, "refused.observed", 2, MatchConfig(bucket_seconds=300))
    clustered.save_spans(matching.departure_spans(planned(spark, "08:00:00")), "refused.spans", 2)
    with pytest.raises(ValueError, match="different parameters"):
        clustered.match_saved(spark, "refused.observed", "refused.spans")
    clustered.save_observed(passages.filter(F.lit(False)), "refused.observed", 2)
    assert clustered.match_saved(spark, "refused.observed", "refused.spans").collect() == []

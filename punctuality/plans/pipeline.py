"""The dataset pipeline: each stage reads datasets, writes datasets and returns the number of rows written.

Stages meet only in storage, so a stage can be run again, an executor lost in one does not reach into the stage
before, and statistics of the files are known to the next plan.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from punctuality.config import MatchConfig
from punctuality.operators import indicators, ranking
from punctuality.operators.matching import judge, match_to_loads
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.operators.schedule import build_schedule
from punctuality.sources import catalog
from punctuality.sources.sinks import export_report, write_parquet
from punctuality.sources.publication import Publication
from punctuality.sources.schedules import load_schedule, read_loads
from punctuality.sources.store import Store
from punctuality.sources.tables import read_feed, read_parquet
from punctuality.streaming import collect_arrivals, read_documents, read_rollups, read_samples


@dataclass(frozen=True)
class Layout:
    """Where the datasets of one installation lie."""

    root: str

    def __getitem__(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{FOLDERS[dataset]}"


# Dataset locations below the root.
FOLDERS = {
    "feed": "raw/gtfs",
    "snapshots": "raw/realtime",
    "mended": "raw/mended",
    "schedule": "processed/gtfs/gtfs_schedule.parquet",
    "spans": "processed/gtfs/departure_spans.parquet",
    "passages": "processed/realtime/realtime_passages.parquet",
    "matched": "final/matched_observations.parquet",
    "published": "analytics/published",
    "rollup": "analytics/rollup",
    "line_performance": "analytics/line_performance",
    "stop_performance": "analytics/stop_performance",
    "disruption_reasons": "analytics/disruption_reasons",
    "network_overview": "analytics/network_overview",
    "exports": "reports/exports",
    "clean_feed": "processed/gtfs",
    "arrivals": "final/arrivals.parquet",
    "arrivals_state": "state/arrivals",
    "reports_state": "state/reports",
}

INDICATORS = {
    "line_performance": indicators.line_performance,
    "stop_performance": indicators.stop_performance,
    "disruption_reasons": indicators.disruption_reasons,
    "network_overview": indicators.network_overview,
}


def make_schedule(
    spark: SparkSession, at: Layout, config: MatchConfig = MatchConfig(), valid_from: str | None = None
) -> dict[str, int]:
    """Feed tables → schedule, and a load of the spans that every match run needs from it, which holds from a service date on.

    Loads before it stay as they are, so a stream or a match that reads them is not disturbed.
    """
    feed = read_feed(spark, at["feed"])
    rows = {"schedule": write_parquet(build_schedule(**feed), at["schedule"])}
    return rows | {"spans": load_schedule(read_parquet(spark, at["schedule"]), at["spans"], valid_from, config).rows}


def make_passages(spark: SparkSession, at: Layout) -> dict[str, int]:
    """Snapshot files → documents → passages. A file is opened once, by this stage or by the stream: both share the
    documents and the record of what is taken. Damaged files are set aside, see :func:`punctuality.streaming.read_quarantine`."""
    collect_arrivals(spark, at["snapshots"], at["arrivals"], at["arrivals_state"]).awaitTermination()
    found = build_passages(flatten_snapshots(read_documents(spark, at["arrivals"])))
    return {"passages": write_parquet(found, at["passages"])}


def make_matches(spark: SparkSession, at: Layout, config: MatchConfig = MatchConfig()) -> dict[str, int]:
    """Passages and spans → matched observations. The config must be the one the spans were made under."""
    loads = [(load.valid_from, load.spans) for load in read_loads(spark, at["spans"])]
    matches = match_to_loads(read_parquet(spark, at["passages"]), loads, config)
    return {"matched": write_parquet(judge(matches, config), at["matched"])}


def make_indicators(spark: SparkSession, at: Layout, streamed: bool = False) -> dict[str, int]:
    """Matched observations → rollup → indicator datasets and samples, published as one set.

    With ``streamed`` the rollup is the sum of what the stream's batches have left, and no observation is read at all.
    """
    def figures(made: Mapping[str, DataFrame]) -> DataFrame:
        if streamed:
            return indicators.added(read_rollups(spark, at["arrivals"]), *indicators.ROLLUP_KEY)
        return indicators.rollup(read_parquet(spark, at["matched"]))

    def samples(made: Mapping[str, DataFrame]) -> DataFrame:
        return ranking.worst_samples(read_samples(spark, at["arrivals"]) if streamed else read_parquet(spark, at["matched"]))

    makers = {name: lambda made, make=indicator: make(made["rollup"]) for name, indicator in INDICATORS.items()}
    published = Publication(spark, at["published"])
    rows = published.publish({"rollup": figures, **makers, "sample_disruptions": samples})
    rows.pop("sample_disruptions")
    for name, frame in published.read().items():  # the places that other systems read, one after the other
        if name in rows:
            write_parquet(frame, at[name])
    return rows


def reports(spark: SparkSession, at: Layout) -> dict[str, DataFrame]:
    """The report tables by export name, all of a handful of rows and all of the set that was published last."""
    published = Publication(spark, at["published"]).read()
    figures = published["rollup"]
    return {
        "network_overview": indicators.network_kpis(figures),
        "top_lines": ranking.top_lines(published["line_performance"]),
        "top_stops": ranking.top_stops(published["stop_performance"]),
        "disruption_reasons": ranking.top_reasons(figures),
        "sample_disruptions": published["sample_disruptions"],
    }


def export_reports(spark: SparkSession, at: Layout) -> None:
    """Report tables → CSV."""
    for name, rows in reports(spark, at).items():
        export_report(rows, f"{at['exports']}/{name}.csv")


def publish_catalog(
    spark: SparkSession, at: Layout, database: str, prefix: str, place: str | None = None, streamed: bool = False
) -> None:
    """Datasets → catalog tables. With ``streamed`` the stream's matches go to a table by service date, of which only the
    dates that changed are reloaded; the indicators are small and reloaded whole."""
    catalog.create_database(spark, database, place)
    locations = {name: at[name] for name in INDICATORS}
    if streamed:
        catalog.publish_days(Store(spark, at["arrivals"]), "matched", database, prefix)
    else:
        locations["matched_observations"] = at["matched"]
    catalog.publish(spark, database, prefix, locations)


def run_all(spark: SparkSession, at: Layout, config: MatchConfig = MatchConfig()) -> dict[str, int]:
    """All stages up to the CSV reports."""
    rows = make_schedule(spark, at, config) | make_passages(spark, at) | make_matches(spark, at, config)
    rows |= make_indicators(spark, at)
    export_reports(spark, at)
    return rows

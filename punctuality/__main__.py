"""Pipeline stages from the command line, for spark-submit or a local run.

    spark-submit … -m punctuality schedule passages match indicators exports --root hdfs://…/project
    python -m punctuality all --root data --master 'local[*]'
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from punctuality.config import MatchConfig
from punctuality.plans import pipeline
from punctuality.schemas import FEED_COLUMNS
from punctuality.sources.sinks import clean_feed
from punctuality.sources.store import Store
from punctuality.streaming import FILES_PER_BATCH, audit_days, collect_reports, compact, match_arrivals, rematch, replay_mended

STAGES = ("schedule", "passages", "match", "indicators", "exports")
EXTRA = ("clean", "catalog", "stream", "replay", "rematch", "compact", "audit")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="punctuality", description="Service-punctuality pipeline")
    parser.add_argument("stages", nargs="+", choices=("all", *STAGES, *EXTRA))
    parser.add_argument("--root", required=True, help="folder or URI that holds the datasets")
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    parser.add_argument("--time-zone", default="Europe/Paris", help="zone in which instants are read as clock time")
    parser.add_argument("--rollover-hour", type=int, default=MatchConfig.rollover_hour)
    parser.add_argument("--tolerance-seconds", type=int, default=MatchConfig.tolerance_seconds)
    parser.add_argument("--delay-threshold-minutes", type=float, default=MatchConfig.delay_threshold_minutes)
    parser.add_argument("--collapse-whitespace", action="store_true", help="match stop names across runs of spaces")
    parser.add_argument("--streamed", action="store_true", help="indicators and catalog from the batches of the stream stage")
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="snapshot files in a micro-batch")
    parser.add_argument("--valid-from", help="first service date of the schedule that is loaded; all dates if left out")
    parser.add_argument("--database", default="punctuality", help="database of the catalog stage")
    parser.add_argument("--prefix", default="main", help="table prefix of the catalog stage")
    return parser.parse_args(argv)


def run(spark: SparkSession, asked: argparse.Namespace) -> dict[str, int]:
    """Run the stages in the order given; returns the rows written per dataset."""
    at = pipeline.Layout(asked.root)
    config = MatchConfig(
        rollover_hour=asked.rollover_hour,
        tolerance_seconds=asked.tolerance_seconds,
        delay_threshold_minutes=asked.delay_threshold_minutes,
        collapse_whitespace=asked.collapse_whitespace,
        time_zone=asked.time_zone,
    )

    def stream() -> None:
        match_arrivals(
            spark, at["snapshots"], at["spans"], at["arrivals"], at["arrivals_state"], config, asked.files_per_batch
        ).awaitTermination()

    def report() -> None:
        collect_reports(spark, at["snapshots"], at["arrivals"], at["reports_state"]).awaitTermination()
        print("audited:", *audit_days(Store(spark, at["arrivals"])))

    def clean() -> None:
        files = {f"{at['feed']}/{name}.txt": f"{at['clean_feed']}/{name}.csv" for name in FEED_COLUMNS}
        for source, error in clean_feed(spark, files).items():
            print(f"{source}: {error or 'cleaned'}")

    actions = {
        "schedule": lambda: pipeline.make_schedule(spark, at, config, asked.valid_from),
        "passages": lambda: pipeline.make_passages(spark, at),
        "match": lambda: pipeline.make_matches(spark, at, config),
        "indicators": lambda: pipeline.make_indicators(spark, at, asked.streamed),
        "exports": lambda: pipeline.export_reports(spark, at),
        "catalog": lambda: pipeline.publish_catalog(spark, at, asked.database, asked.prefix, streamed=asked.streamed),
        "replay": lambda: {"mended": replay_mended(spark, at["mended"], at["arrivals"])},
        "rematch": lambda: rematch(Store(spark, at["arrivals"]), at["spans"], config) and None,
        "audit": report,
        "compact": lambda: compact(Store(spark, at["arrivals"])) and None,
        "clean": clean,
        "stream": stream,
    }
    rows: dict[str, int] = {}
    for stage in asked.stages:
        for name in STAGES if stage == "all" else (stage,):
            rows |= actions[name]() or {}
    return rows


def main(argv: list[str] | None = None) -> None:
    asked = arguments(argv)
    builder = SparkSession.builder.appName("punctuality")
    if asked.master:
        builder = builder.master(asked.master)
    spark = builder.getOrCreate()
    for dataset, count in run(spark, asked).items():
        print(f"{dataset}: {count} rows")
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     runs of each query; the median counts (default 3)
BENCH_SCRATCH  shared folder for intermediate data (default a new temporary one; the bench runs on one machine)
               and stop and exist only here, as the yardstick
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality import MatchConfig
from punctuality.operators import matching
from punctuality.plans import adapters, queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "schedule_build",
    "observations_flatten",
    "candidate_pairs",
    "nearest_match",
    "nearest_match_window",
    "matched_classified",
    "line_performance",
    "stop_performance",
    "network_kpis",
    "reason_share",
    "top_lines",
    "chart_series",
    "worst_samples",
    "parquet_publish",
    "stream_ingest_match",
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def shapes(spark: SparkSession) -> dict[str, float]:
    """Seconds of other shapes of the match, and of ours, over the same inputs."""
    config = MatchConfig()
    planned = matching.planned_departures(queries._schedule(spark, SF_DIR), config)
    observed = matching._placed(matching._reports(adapters.passages(spark, SF_DIR), config), config)
    gap = F.abs(F.col("expected_seconds") - F.col("planned_seconds"))
    near = gap <= config.tolerance_seconds
    same = list(matching.GROUP)
    order = (gap, "planned_seconds", *matching.PLANNED_TIE)

    def top_by_window(pairs: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*matching.PASSAGE_KEY).orderBy(*order))
        return pairs.withColumn("place", place).filter("place = 1")

    def top_by_aggregate(pairs: DataFrame) -> DataFrame:
        payload = F.struct(*[c for c in pairs.columns if c not in matching.PASSAGE_KEY])
        best = F.min_by(payload, F.struct(gap, "planned_seconds", *matching.PLANNED_TIE))
        return pairs.groupBy(*matching.PASSAGE_KEY).agg(best.alias("best"))

    width = config.tolerance_seconds
    banded = observed.withColumn(
        "band", F.explode(F.array(*[F.floor(F.col("expected_seconds") / width) + n for n in (-1, 0, 1)]))
    ).join(planned.withColumn("band", F.floor(F.col("planned_seconds") / width)), [*same, "band"])
    pairs = observed.join(planned, same)
    ours = lambda: matching.match_passages(adapters.passages(spark, SF_DIR), queries._schedule(spark, SF_DIR))
    plans = {
        "V0 pairs, window, late gate": lambda: top_by_window(pairs).filter(near),
        "V1 pairs, gate first, window": lambda: top_by_window(pairs.filter(near)),
        "V2 pairs, gate first, aggregate": lambda: top_by_aggregate(pairs.filter(near)),
        "V3 banded pairs, aggregate": lambda: top_by_aggregate(banded.filter(near)),
        "ours: winning spans": ours,
    }
    return {name: timed(lambda build=build: run(build())) for name, build in plans.items()}


def main() -> None:
    spark = session()
    registered = queries.QUERIES
    run(registered["line_performance"](spark, SF_DIR))  # class loading and code generation
    rounds = [{name: timed(lambda name=name: run(registered[name](spark, SF_DIR))) for name in HEADLINE} for _ in range(RUNS)]
    seconds = {name: round(median(each[name] for each in rounds), 3) for name in HEADLINE}
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
    }
    if os.environ.get("BENCH_SHAPES"):
        line["shapes"] = shapes(spark)
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

"""Passages and spans laid out by line, stop and time bucket, so that matching them again moves nothing.

Both sides are tables with the same number of buckets over the join's key. The rows are dealt out and merged once, when
they are written; every match after that (other delay thresholds, another load of spans) joins bucket with bucket. A
group that holds a large part of all passages lies in many buckets, one for each quarter of an hour; within one, nothing
splits it, so a number of buckets is chosen with which the largest fits a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.config import MatchConfig
from punctuality.operators import matching, nearest

KEY = (*matching.GROUP, "bucket")


def _save(rows: DataFrame, table: str, buckets: int) -> None:
    # Dealt out as the table is, so that every task writes the one file of its bucket.
    spread = rows.repartition(buckets, *KEY)
    spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table)


def save_spans(spans: DataFrame, table: str, buckets: int) -> None:
    """Write :func:`punctuality.operators.matching.departure_spans` as a bucketed table."""
    _save(spans, table, buckets)


def save_observed(passages: DataFrame, table: str, buckets: int, config: MatchConfig = MatchConfig()) -> None:
    """Write passages, merged to one row per observation, as a bucketed table for spans of the config's bucket width."""
    observed = matching.observed_departures(passages, config)
    width = F.floor(F.col("expected_seconds") / config.bucket_seconds).cast("int")
    parameters = {"bucket": config.bucket_seconds, **matching.span_parameters(config)}
    _save(observed.withColumn("bucket", width).withMetadata("bucket", parameters), table, buckets)


def match_saved(spark: SparkSession, observed: str, spans: str) -> DataFrame:
    """Passages with their planned departure, from both tables; a join without an exchange.

    Tables made under different parameters are refused.
    """
    left, right = spark.table(observed), spark.table(spans)
    if nearest.made_under(left) != nearest.made_under(right):
        raise ValueError(f"made under different parameters: {nearest.made_under(left)}, {nearest.made_under(right)}")
    return nearest.join_in_buckets(left, right.hint("merge"), matching.GROUP, "expected_seconds")

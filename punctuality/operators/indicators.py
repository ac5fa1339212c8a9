"""Indicators of lines, stops, reasons and the network.

All of them are sums over the same matched rows, so the rows are read once: :func:`rollup` adds them up per line,
stop and reason, with a map-side combine, and every indicator is a second, small aggregate of that. Sums are whole
numbers (minutes in hundredths), hence the same in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.functions import mean_minutes, part_of_total_pct, rate_pct, reason_title
from punctuality.functions.verdict import NORMAL

ROLLUP_KEY = ("line_code", "route_short_name", "stop_point_name", "disruption_reason")
ROLLUP_SUMS = ("observations", "delay_hundredths", "delayed", "disrupted", "cancelled")


def rollup(matched: DataFrame, *by: str) -> DataFrame:
    """Additive figures per line, stop and reason, and per ``by``. Flags that are NULL count as not set."""
    hundredths = F.round(F.col("delay_minutes") * 100).cast("bigint")
    return matched.groupBy(*ROLLUP_KEY, *by).agg(
        F.count(F.lit(1)).alias("observations"),
        F.sum(hundredths).alias("delay_hundredths"),
        F.count_if("is_delayed").alias("delayed"),
        F.count_if("is_disrupted").alias("disrupted"),
        F.count_if("is_cancelled").alias("cancelled"),
    )


def added(figures: DataFrame, *key: str) -> DataFrame:
    """Figures of a rollup summed up by ``key``. A group whose observations were all taken back is none."""
    summed = figures.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ROLLUP_SUMS])
    return summed.filter("observations <> 0") if key else summed


def corrections(wrong: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    """Figures that, added to those of a rollup, put ``right`` matched rows in the place of ``wrong`` ones."""
    taken_back = rollup(wrong, *by).withColumns({c: -F.col(c) for c in ROLLUP_SUMS})
    summed = taken_back.unionByName(rollup(right, *by)).groupBy(*ROLLUP_KEY, *by).agg(*[F.sum(c).alias(c) for c in ROLLUP_SUMS])
    return summed.filter(" or ".join(f"{c} <> 0" for c in ROLLUP_SUMS))


def _rate(hits: str) -> Column:
    return rate_pct(F.col(hits), F.col("observations"))


def _mean_delay() -> Column:
    return mean_minutes(F.col("delay_hundredths"), F.col("observations"))


def line_performance(figures: DataFrame) -> DataFrame:
    """Per line code and short name; a missing short name is a group of its own."""
    return added(figures, "line_code", "route_short_name").select(
        "line_code",
        "route_short_name",
        "observations",
        _mean_delay().alias("avg_delay_minutes"),
        _rate("delayed").alias("delay_rate_pct"),
        _rate("disrupted").alias("disruption_rate_pct"),
    )


def stop_performance(figures: DataFrame) -> DataFrame:
    """Per stop name as observed, not as normalised for the match."""
    return added(figures, "stop_point_name").select(
        "stop_point_name",
        "observations",
        _mean_delay().alias("avg_delay_minutes"),
        _rate("disrupted").alias("disruption_rate_pct"),
    )


def disruption_reasons(figures: DataFrame) -> DataFrame:
    """How often each reason occurs, the normal one included."""
    return figures.groupBy("disruption_reason").agg(F.sum("observations").alias("events")).filter("events <> 0")


def network_overview(figures: DataFrame) -> DataFrame:
    """One row for the network. Without observations the count is 0 and the rest NULL."""
    return added(figures).select(
        F.coalesce("observations", F.lit(0)).alias("total_observations"),
        F.col("disrupted").alias("disrupted_observations"),
        F.col("cancelled").alias("cancelled_observations"),
        _mean_delay().alias("network_avg_delay_minutes"),
    )


def network_kpis(figures: DataFrame) -> DataFrame:
    """One row for the network with exact numbers of lines and stops, and rates that are 0 without observations."""
    # Lines and stops are told apart on the rollup, so the distinct counts never touch the matched rows. Rows that were taken
    # back by later ones must not count, so the rollup's rows are added up by line and stop first.
    row = added(figures, "line_code", "stop_point_name").agg(
        F.coalesce(F.sum("observations"), F.lit(0)).alias("total_observations"),
        F.count_distinct("line_code").alias("distinct_lines"),
        F.count_distinct("stop_point_name").alias("distinct_stops"),
        F.sum("delayed").alias("delayed_observations"),
        F.sum("disrupted").alias("disrupted_observations"),
        F.sum("cancelled").alias("cancelled_observations"),
        mean_minutes(F.sum("delay_hundredths"), F.sum("observations")).alias("network_avg_delay_minutes"),
    )
    total = F.col("total_observations")
    return row.withColumns(
        {
            "delay_rate_pct": part_of_total_pct(F.col("delayed_observations"), total),
            "disruption_rate_pct": part_of_total_pct(F.col("disrupted_observations"), total),
            "cancellation_rate_pct": part_of_total_pct(F.col("cancelled_observations"), total),
        }
    )


def reason_shares(figures: DataFrame) -> DataFrame:
    """Events of each reason but the normal one, its display text, and its share of all disrupted observations."""
    # The window runs over one row per reason, of which there are four.
    total = F.sum("events").over(Window.partitionBy())
    return (
        disruption_reasons(figures)
        .filter(F.col("disruption_reason") != NORMAL)
        .select(
            "disruption_reason",
            "events",
            reason_title(F.col("disruption_reason")).alias("motif"),
            part_of_total_pct(F.col("events"), total).alias("share_pct"),
        )
    )

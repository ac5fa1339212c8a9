"""Top-k reports. Every order ends with the key columns, so the rows listed do not change between runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.functions import line_title, reason_title
from punctuality.functions.text import UNKNOWN
from punctuality.operators.indicators import reason_shares

# Lengths of the report tables, and the columns of a sample.
TOP_UNITS = 6
TOP_REASONS = 8
TOP_SAMPLES = 10
SAMPLE_COLUMNS = ("line_code", "stop_point_name", "expected_departure_time", "delay_minutes", "disruption_reason")


def top_rows(rows: DataFrame, largest: Sequence[str], key: Sequence[str], k: int) -> DataFrame:
    """The ``k`` first rows by the given columns, largest first and NULLs last, then by key."""
    order = [F.col(c).desc_nulls_last() for c in largest] + [F.col(c).asc_nulls_first() for c in key]
    return rows.orderBy(*order).limit(k)


def top_preferred(
    rows: DataFrame,
    preferred: Column,
    largest: Sequence[str],
    fallback_largest: Sequence[str],
    key: Sequence[str],
    k: int,
) -> DataFrame:
    """Top ``k`` of the preferred rows by ``largest``; if no row is preferred, top ``k`` of all by the fallback.

    One plan and one pass: preferred rows are sorted before the others, each kind by its own order, and of the
    ``k`` rows kept the others go if a preferred row is among them.
    """
    is_preferred = F.coalesce(preferred, F.lit(False))
    marked = rows.withColumn("preferred", is_preferred)
    chosen = F.col("preferred")
    order = [
        chosen.desc(),
        *[F.when(chosen, F.col(c)).desc_nulls_last() for c in largest],
        *[F.when(~chosen, F.col(c)).desc_nulls_last() for c in fallback_largest],
        *[F.col(c).asc_nulls_first() for c in key],
    ]
    # The window sees the k rows kept, not the table.
    any_chosen = F.max("preferred").over(Window.partitionBy())
    return (
        marked.orderBy(*order)
        .limit(k)
        .withColumn("any_preferred", any_chosen)
        .filter(chosen | ~F.col("any_preferred"))
        .select(*rows.columns)
    )


def _most_disrupted(performance: DataFrame, key: Sequence[str], k: int) -> DataFrame:
    return top_preferred(
        performance,
        preferred=F.col("disruption_rate_pct") > 0,
        largest=["disruption_rate_pct", "observations", "avg_delay_minutes"],
        fallback_largest=["observations", "avg_delay_minutes"],
        key=key,
        k=k,
    )


def top_lines(line_performance: DataFrame, k: int = TOP_UNITS) -> DataFrame:
    """Most disrupted lines, or the busiest if none is disrupted."""
    return _most_disrupted(line_performance, ["line_code", "route_short_name"], k).select(
        line_title(F.col("line_code"), F.col("route_short_name")).alias("line"),
        "observations",
        "avg_delay_minutes",
        "delay_rate_pct",
        "disruption_rate_pct",
    )


def top_stops(stop_performance: DataFrame, k: int = TOP_UNITS) -> DataFrame:
    """Most disrupted stops, or the busiest if none is disrupted."""
    return _most_disrupted(stop_performance, ["stop_point_name"], k)


def top_reasons(figures: DataFrame, k: int = TOP_REASONS) -> DataFrame:
    """Most frequent reasons with their shares. Takes the rollup: shares refer to all disrupted observations."""
    return top_rows(reason_shares(figures), ["events"], ["disruption_reason"], k)


def _longest_delays(key: Sequence[str]) -> list[Column]:
    return [F.col("delay_minutes").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in key]]


def sample_candidates(matched: DataFrame, by: str, k: int = TOP_SAMPLES) -> DataFrame:
    """The rows that :func:`worst_samples` may list: for each value of ``by`` the ``k`` first of its disrupted observations.

    Candidates of several inputs may be put together and cut again; their worst samples are those of all rows. Every task
    keeps ``k`` rows a value before the shuffle.
    """
    key = [c for c in SAMPLE_COLUMNS if c != "delay_minutes"]
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*_longest_delays(key)))
    disrupted = matched.filter("is_disrupted").select(*SAMPLE_COLUMNS, "is_disrupted", by)
    return disrupted.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def worst_samples(matched: DataFrame, k: int = TOP_SAMPLES) -> DataFrame:
    """Disrupted observations with the longest delays, of matched rows or of :func:`sample_candidates`."""
    disrupted = matched.filter("is_disrupted").select(*SAMPLE_COLUMNS)
    key = [c for c in SAMPLE_COLUMNS if c != "delay_minutes"]
    return top_rows(disrupted, ["delay_minutes"], key, k).withColumn(
        "disruption_reason", reason_title(F.col("disruption_reason"))
    )


def chart_series(lines: DataFrame, stops: DataFrame, reasons: DataFrame) -> DataFrame:
    """Bars of the three charts, from the three top-k tables: chart, label, value."""

    def bars(rows: DataFrame, chart: str, label: str, value: str) -> DataFrame:
        return rows.select(
            F.lit(chart).alias("chart"),
            F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit(UNKNOWN)).alias("label"),
            F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"),
        )

    charts = [
        bars(lines, "top_lines", "line", "disruption_rate_pct"),
        bars(stops, "top_stops", "stop_point_name", "disruption_rate_pct"),
        bars(reasons, "disruption_reasons", "motif", "events"),
    ]
    return reduce(DataFrame.unionByName, charts)

"""Nearest-in-time join with tolerance.

For every observed row: the planned row of the same group whose time is closest in either direction, if it is no
further than the tolerance. Among equally close rows the earlier time wins, then the smallest planned tie columns
(NULLs first).

No pair of rows that loses is ever produced. Which planned row wins depends only on the group and the time, so

* planned rows with equal group and time are first reduced to the one that can win;
* each remaining row then wins exactly one span of times, which ends half-way to its neighbours. Spans of a group
  do not overlap;
* spans are cut at the borders of fixed time buckets, and an observed row looks for its span in its own bucket.
  The join is therefore an equi-join on (group, bucket) with at most one result per observed row, and the spans
  of one bucket number at most ``bucket``, however many rows a group has.

Observed rows are never grouped by group or time: a group that holds a large part of them is spread over its
buckets, and adaptive execution splits a bucket that is still too large, since its spans are few. The plan has no
broadcast hint: Spark broadcasts the spans where their measured size allows and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(time: str, width: int) -> Column:
    return F.floor(F.col(time) / width).cast("int")


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest order columns, NULLs first.

    A filter on ``row_number`` keeps one row per key in every task before the shuffle as well, so copies of a key
    do not meet in one task. For text columns this is cheaper than an aggregate, which would have to sort, too.
    """
    sort = [F.col(c).asc_nulls_first() for c in order]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*sort))
    return rows.withColumn("rank", rank).filter("rank = 1").drop("rank")


def winning_spans(
    planned: DataFrame,
    on: Sequence[str],
    time: str,
    tie: Sequence[str],
    tolerance: int,
    first: int,
    last: int,
    bucket: int,
) -> DataFrame:
    """The span of observed times that each planned row wins, once per time bucket it reaches into.

    Observed times lie in ``first..last``; planned times out of reach of that are dropped, so a group keeps at most
    ``last - first + 1 + 2 * tolerance`` rows, whatever the size of the input. The four numbers travel with the spans
    as metadata of the bucket column, which Parquet keeps, so spans cannot be read under other ones by mistake.
    """
    reachable = planned.filter(F.col(time).between(first - tolerance, last + tolerance))
    winners = first_per_key(reachable, [*on, time], tie)
    here = F.col(time)
    in_time = Window.partitionBy(*on).orderBy(time)
    before, after = F.lag(time).over(in_time), F.lead(time).over(in_time)
    # The middle belongs to the earlier row. greatest and least skip the missing neighbour at either end.
    span_start = F.greatest(F.lit(first), here - tolerance, F.floor((before + here) / 2) + 1)
    span_end = F.least(F.lit(last), here + tolerance, F.floor((here + after) / 2))
    return (
        winners.withColumns({"span_start": span_start.cast("int"), "span_end": span_end.cast("int")})
        .filter("span_start <= span_end")
        .withColumn("bucket", F.explode(F.sequence(_bucket("span_start", bucket), _bucket("span_end", bucket))))
        .withMetadata("bucket", {"bucket": bucket, "tolerance": tolerance, "first": first, "last": last})
    )


def made_under(spans: DataFrame) -> dict[str, int]:
    """bucket, tolerance, first and last that spans were made under."""
    found = spans.schema["bucket"].metadata
    if "bucket" not in found:
        raise ValueError("the spans have lost their parameters: read them as Parquet files, not by a table or a stated schema")
    return found


def join_spans(observed: DataFrame, spans: DataFrame, on: Sequence[str], time: str) -> DataFrame:
    """Observed rows with the planned row whose span holds their time; rows without one are dropped."""
    return join_in_buckets(observed.withColumn("bucket", _bucket(time, made_under(spans)["bucket"])), spans, on, time)


def join_in_buckets(observed: DataFrame, spans: DataFrame, on: Sequence[str], time: str) -> DataFrame:
    """:func:`join_spans` of observed rows that have their ``bucket`` already, which goes."""
    o, s = observed.alias("o"), spans.alias("s")
    same_cell = [F.col(f"o.{c}") == F.col(f"s.{c}") for c in (*on, "bucket")]
    within = F.col(f"o.{time}").between(F.col("s.span_start"), F.col("s.span_end"))
    hidden = {*on, "bucket", "span_start", "span_end"}
    won = [F.col(f"s.{c}") for c in spans.columns if c not in hidden]
    return o.join(s, [*same_cell, within]).select("o.*", *won).drop("bucket")


def nearest_match(
    observed: DataFrame,
    planned: DataFrame,
    *,
    on: Sequence[str],
    observed_time: str,
    planned_time: str,
    planned_tie: Sequence[str],
    tolerance: int,
    first: int,
    last: int,
    bucket: int = 900,
) -> DataFrame:
    """The join described above, for whole-number times. Observed times must lie in ``first..last``."""
    spans = winning_spans(planned, on, planned_time, planned_tie, tolerance, first, last, bucket)
    return join_spans(observed, spans, on, observed_time)


def nearest_match_windowed(
    observed: DataFrame,
    planned: DataFrame,
    *,
    on: Sequence[str],
    observed_time: str,
    planned_time: str,
    planned_tie: Sequence[str],
    tolerance: int,
    first: int,
    last: int,
) -> DataFrame:
    """Same rows as :func:`nearest_match`, through window functions.

    The distinct observed times of each group are laid on one line with the planned times; a look back and a look
    ahead find the two neighbours, and the answer is joined back to the observed rows. A window holds distinct
    times only, so its size is bounded by the length of the day. It reads the observed rows twice and is the
    second choice for large inputs.
    """
    reachable = planned.filter(F.col(planned_time).between(first - tolerance, last + tolerance))
    winners = first_per_key(reachable, [*on, planned_time], planned_tie)
    carried = [c for c in winners.columns if c not in on]
    moment = "moment"
    asked = observed.select(*on, F.col(observed_time).alias(moment)).distinct()
    offered = winners.select(*on, F.col(planned_time).alias(moment), F.struct(*carried).alias("offer"))
    line = asked.withColumn("asks", F.lit(True)).unionByName(
        offered.withColumn("asks", F.lit(False)), allowMissingColumns=True
    )

    def neighbour(direction: Column) -> Column:
        # Ahead is a look back along the reversed line: a frame that grows is linear, one that shrinks is not.
        frame = Window.partitionBy(*on).orderBy(direction, "asks").rowsBetween(Window.unboundedPreceding, 0)
        return F.last("offer", ignorenulls=True).over(frame)

    def distance(offer: str) -> Column:
        return F.abs(F.col(moment) - F.col(f"{offer}.{planned_time}"))

    nearer = F.when(distance("ahead") < distance("back"), F.col("ahead")).otherwise(
        F.coalesce(F.col("back"), F.col("ahead"))
    )
    answers = (
        line.withColumn("back", neighbour(F.col(moment).asc()))
        .withColumn("ahead", neighbour(F.col(moment).desc()))
        .filter("asks")
        .withColumn("nearer", nearer)
        .filter(distance("nearer") <= tolerance)
        .select(*on, F.col(moment).alias(observed_time), "nearer.*")
    )
    return observed.join(answers, [*on, observed_time])


def pair_statistics(
    observed: DataFrame,
    planned: DataFrame,
    *,
    on: Sequence[str],
    observed_time: str,
    planned_time: str,
    tolerance: int,
    first: int,
    last: int,
) -> DataFrame:
    """Per group: how many (observed, planned) pairs an equi-join would give, how many of them lie within the
    tolerance, and the sum of their time differences. Groups missing on either side give no row. Products of two
    large counts outgrow 64 bits, so these figures are decimals.

    The pairs themselves are not produced. Both sides are counted per distinct time; running totals along time
    then tell how many planned rows lie before any moment and what their times add up to. Observed times lie in
    ``first..last``, so planned rows beyond reach on either side are added up as one, which bounds a group.
    """
    asked = observed.groupBy(*on, F.col(observed_time).alias("moment")).agg(F.count(F.lit(1)).alias("weight"))
    bounded = F.least(F.lit(last + tolerance + 1), F.greatest(F.lit(first - tolerance - 1), F.col(planned_time)))
    marks = planned.groupBy(*on, bounded.alias("at")).agg(
        F.count(F.lit(1)).alias("offers"), F.sum(planned_time).alias("times")
    )
    # Each asked moment probes the running totals at three places: at itself and at both ends of the tolerance.
    probes = asked.withColumn(
        "probe",
        F.explode(
            F.array(
                F.struct(F.lit("here").alias("kind"), F.col("moment").alias("at")),
                F.struct(F.lit("end").alias("kind"), (F.col("moment") + tolerance).alias("at")),
                F.struct(F.lit("start").alias("kind"), (F.col("moment") - tolerance - 1).alias("at")),
            )
        ),
    ).select(*on, "moment", "weight", "probe.kind", "probe.at")
    line = probes.unionByName(marks, allowMissingColumns=True)
    group = Window.partitionBy(*on)
    # A range frame includes all rows at the same moment, so probes see planned rows at their own moment.
    so_far = group.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    offers, times = F.coalesce("offers", F.lit(0)), F.coalesce("times", F.lit(0))
    at, weight = F.col("at").cast("bigint"), F.col("weight").cast("decimal(19,0)")
    counted = line.select(
        *on,
        "kind",
        "weight",
        "at",
        F.sum(offers).over(so_far).alias("n"),
        F.sum(times).over(so_far).alias("t"),
        F.sum(offers).over(group).alias("n_all"),
        F.sum(times).over(group).alias("t_all"),
    ).filter("kind IS NOT NULL AND n_all > 0")
    n, t, n_all, t_all = (F.col(c) for c in ("n", "t", "n_all", "t_all"))
    apart = (at * n - t) + (t_all - t - at * (n_all - n))
    here = F.col("kind") == "here"

    def total(value: Column) -> Column:
        return F.sum(value).cast("decimal(38,0)")

    inside = F.when(F.col("kind") == "end", n).when(F.col("kind") == "start", -n).otherwise(0)
    return counted.groupBy(*on).agg(
        F.sum(F.when(here, F.col("weight"))).alias("observed_rows"),
        F.max("n_all").alias("planned_rows"),
        total(F.when(here, weight * n_all)).alias("candidate_pairs"),
        total(weight * inside).alias("pairs_in_tolerance"),
        total(F.when(here, weight * apart)).alias("gap_seconds"),
    )

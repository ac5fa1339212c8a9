"""The nearest-in-time join against brute force, its bounds and its plan."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from punctuality.operators.nearest import (
    first_per_key,
    nearest_match,
    nearest_match_windowed,
    pair_statistics,
    winning_spans,
)

FIRST, LAST = 14_400, 100_799
JOIN = dict(on=["g"], observed_time="t", planned_time="p", planned_tie=["trip"])


def frames(spark, observed, planned):
    return (
        spark.createDataFrame(observed, "id int, g string, t int"),
        spark.createDataFrame(planned, "g string, p int, trip string"),
    )


def brute_force(observed, planned, tolerance):
    found = []
    for key, group, t in observed:
        near = [(abs(t - p), p, trip or "") for g, p, trip in planned if g == group and abs(t - p) <= tolerance]
        if near:
            _, p, trip = min(near)
            found.append((key, group, t, p, trip or None))
    return sorted(found, key=repr)


def random_case(seed, seconds):
    draw = random.Random(seed)
    groups = ["a", "b", "c", "only-observed"]
    low, high = FIRST, FIRST + seconds
    observed = [(i, draw.choice(groups), draw.randrange(low, high)) for i in range(250)]
    observed += [(1000, "a", FIRST), (1001, "a", LAST), (1002, "c", LAST)]
    planned = [
        (draw.choice(["a", "b", "c", "only-planned"]), draw.randrange(low - 800, high + 800), draw.choice(["x", "y", None]))
        for _ in range(200)
    ]
    planned += [("a", LAST + 50, "z"), ("c", 0, "z"), ("a", FIRST - 7_300, "z"), ("b", 999_999, "z")]
    return observed, planned


@pytest.mark.parametrize(
    "tolerance, bucket, seconds", [(0, 1, 300), (60, 900, 3_000), (300, 60, 3_000), (900, 900, 40_000), (7_200, 1_000, 86_400)]
)
def test_both_forms_equal_brute_force(spark, tolerance, bucket, seconds):
    observed, planned = random_case(tolerance + bucket, seconds)
    expected = brute_force(observed, planned, tolerance)
    o, p = frames(spark, observed, planned)
    bounds = dict(tolerance=tolerance, first=FIRST, last=LAST)
    assert rows_of(nearest_match(o, p, **JOIN, **bounds, bucket=bucket)) == expected
    windowed = nearest_match_windowed(o, p, **JOIN, **bounds).select("id", "g", "t", "p", "trip")
    assert rows_of(windowed) == expected


def test_tolerance_is_inclusive_and_earlier_wins_a_tie(spark):
    observed = [(1, "g", 50_000), (2, "h", 50_000), (3, "tie", 36_300)]
    planned = [("g", 57_200, "x"), ("h", 57_201, "x"), ("tie", 36_000, "x"), ("tie", 36_600, "a")]
    o, p = frames(spark, observed, planned)
    found = nearest_match(o, p, **JOIN, tolerance=7_200, first=FIRST, last=LAST)
    assert rows_of(found) == [(1, "g", 50_000, 57_200, "x"), (3, "tie", 36_300, 36_000, "x")]


def test_same_time_is_settled_by_the_tie_columns(spark):
    o, p = frames(spark, [(1, "g", 20_000)], [("g", 20_000, "b"), ("g", 20_000, "a"), ("g", 20_000, "a")])
    found = nearest_match(o, p, **JOIN, tolerance=10, first=FIRST, last=LAST)
    assert rows_of(found) == [(1, "g", 20_000, 20_000, "a")]


def test_empty_sides(spark):
    o, p = frames(spark, [(1, "g", 20_000)], [("g", 20_000, "a")])
    bounds = dict(tolerance=10, first=FIRST, last=LAST)
    for left, right in ((o.limit(0), p), (o, p.limit(0))):
        assert nearest_match(left, right, **JOIN, **bounds).count() == 0
        assert nearest_match_windowed(left, right, **JOIN, **bounds).count() == 0


def test_spans_of_a_group_are_bounded_and_disjoint(spark):
    """A group that is planned twice in every second keeps one row per second it can be matched in."""
    busy = spark.range(14_000, 101_200).selectExpr("'g' AS g", "int(id) AS p", "explode(array('b', 'a')) AS trip")
    spans = winning_spans(busy, ["g"], "p", ["trip"], 300, FIRST, LAST, 900)
    total = spans.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("span_end") - F.col("span_start") + 1).alias("seconds"),
        F.count_distinct("trip").alias("trips"),
    ).first()
    assert (total.rows, total.seconds, total.trips) == (LAST - FIRST + 1,) * 2 + (1,)


def test_first_per_key_puts_nulls_first(spark):
    rows = spark.createDataFrame([(1, "b", "y"), (1, "a", None), (1, "a", "x"), (2, None, "z")], "k int, a string, b string")
    assert rows_of(first_per_key(rows, ["k"], ["a", "b"])) == [(1, "a", None), (2, None, "z")]


def test_first_per_key_reduces_before_the_shuffle(spark):
    rows = spark.range(0, 1_000, 1, 4).selectExpr("id % 7 AS k", "string(id) AS a")
    plan = plan_of(first_per_key(rows, ["k"], ["a"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_pair_statistics_count_what_a_join_gives(spark):
    observed, planned = random_case(5, 20_000)
    observed += observed[:40]
    o, p = frames(spark, observed, planned)
    pairs = o.alias("o").join(p.alias("p"), F.col("o.g") == F.col("p.g"))
    gap = F.abs(F.col("t") - F.col("p"))
    expected = pairs.groupBy("o.g").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(gap <= 900).alias("inside"), F.sum(gap).alias("gap")
    )
    found = pair_statistics(o, p, on=["g"], observed_time="t", planned_time="p", tolerance=900, first=FIRST, last=LAST)
    got = found.select("g", *[F.col(c).cast("bigint") for c in ("candidate_pairs", "pairs_in_tolerance", "gap_seconds")])
    assert rows_of(got) == rows_of(expected)
    sizes = {r.g: (r.observed_rows, r.planned_rows) for r in found.collect()}
    for group, (n_observed, n_planned) in sizes.items():
        assert n_observed == sum(g == group for _, g, _ in observed)
        assert n_planned == sum(g == group for g, _, _ in planned)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_pair_explosion_and_no_python(spark):
    o, p = frames(spark, *random_case(1, 1_000))
    plan = plan_of(nearest_match(o, p, **JOIN, tolerance=300, first=FIRST, last=LAST))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert node not in plan


def test_hot_group_is_split(spark):
    """Two thirds of the rows observe one group within one bucket: adaptive execution splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = spark.range(0, 200_000, 1, 8).selectExpr("id", "'hot' AS g", "int(20000 + id % 60) AS t")
        cold = spark.range(0, 100_000, 1, 8).selectExpr("id", "'g' || (id % 500) AS g", "int(14400 + id % 86400) AS t")
        planned = spark.range(0, 20_000, 1, 4).selectExpr(
            "IF(id % 2 = 0, 'hot', 'g' || (id % 500)) AS g", "int(14400 + id * 7 % 86400) AS p", "string(id) AS trip"
        )
        found = nearest_match(hot.unionByName(cold), planned, **JOIN, tolerance=7_200, first=FIRST, last=LAST)
        by_group = {r.hot: r["count"] for r in found.groupBy((F.col("g") == "hot").alias("hot")).count().collect()}
        assert by_group[True] == 200_000
        materialised = found.select(F.sum("p"))
        materialised.collect()
        assert "skew=true" in plan_of(materialised)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

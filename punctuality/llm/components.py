"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from punctuality.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each round hangs every node under the
    smallest node it sees, in a number of rounds that grows with the logarithm of the longest path. A hub with
    a large part of all edges is reduced by partial minima and met again in a join that adaptive execution can
    split. Each round is stored, so that a lost executor costs one round at most. Edges with a null end are
    ignored, as are loops and repeats. Raises if the rounds do not settle.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    before = None
    for _ in range(MAX_ROUNDS):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.toDF("a", "b"))
        seen = Observation()
        print_of = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("print")
        current = stored(small.filter("a <> b").distinct().observe(seen, F.count(F.lit(1)).alias("n"), print_of), "star")
        now = (seen.get["n"], seen.get["print"])
        if now == before:
            roots = current.select(F.col("b").alias("a")).distinct()
            return current.unionByName(roots.select("a", F.col("a").alias("b"))).toDF("node", "component")
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

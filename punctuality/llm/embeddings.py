"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products within them.

Centroids are fitted on a bounded sample; every vector is assigned to the cell of its nearest centroid. A vector also
visits each other cell in which a neighbour could lie: with unit vectors x (home cell a) and y (home cell c) and
cos(x, y) >= t, the difference of x.a and x.c is at most sqrt(1 - t^2) |a - c|, since y.c >= y.a. This bound is exact, so no
link is lost; on vectors that form clusters it leaves few cells, on vectors without structure it leaves most of them
and the work nears that of all blocks against all blocks.

Cells are cut into blocks of at most ``block`` vectors by a hash, so a cell with a third of all vectors is many blocks. A
task compares two blocks by one matrix product in double precision. It returns, for each vector, how many it links
with, and a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctuality.llm.common import stored
from punctuality.llm.components import components


@dataclass(frozen=True)
class Cells:
    """Parameters. The sample has ``sample`` vectors at most and there are ``most_cells`` cells at most."""

    threshold: float = 0.9
    block: int = 4096
    sample: int = 20_000
    most_cells: int = 1024
    rounds: int = 10


def unit_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(vec, unit array<double>, sound)``: divided by their length; not sound where there is no direction."""
    held = rows.select(F.col(id_column).cast("long").alias("vec"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    scaled = F.transform("v", lambda x: x / F.col("largest"))
    held = held.withColumn("largest", F.when(finite, largest)).withColumn("sound", F.coalesce(F.col("largest") > 0, F.lit(False)))
    held = held.withColumn("s", F.when(F.col("sound"), scaled))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    return held.withColumn("norm", norm).select("vec", F.transform("s", lambda x: x / F.col("norm")).alias("unit"), "sound")


def spherical_k_means(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Unit centroids; an empty cell takes the vector that lies worst."""
    centroids = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        likeness = sample @ centroids.T
        home, best = likeness.argmax(axis=1), likeness.max(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        empty = np.bincount(home, minlength=cells) == 0
        sums[empty] = sample[np.argsort(best)[: int(empty.sum())]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def _forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Edges from every linked vector to the smallest of its component in a block of ``linked`` pairs."""
    edges: list[tuple[int, int]] = []
    new_row, new_column = linked.any(axis=1), linked.any(axis=0)
    for start in np.flatnonzero(new_row):
        if not new_row[start]:
            continue
        edge_rows, all_rows, all_columns = np.array([start]), [], []
        new_row[start] = False
        while len(edge_rows):
            all_rows.append(edge_rows)
            reached = linked[edge_rows].any(axis=0) & new_column
            new_column &= ~reached
            reached = np.flatnonzero(reached)
            all_columns.append(reached)
            back = linked[:, reached].any(axis=1) & new_row if len(reached) else np.zeros(len(rows), bool)
            new_row &= ~back
            edge_rows = np.flatnonzero(back)
        members = np.unique(np.concatenate((rows[np.concatenate(all_rows)], columns[np.concatenate(all_columns)])))
        edges += [(int(m), int(members[0])) for m in members[1:]]
    return edges


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _located(vectors: DataFrame, centroids: np.ndarray, how: Cells) -> DataFrame:
    """``(vec, unit, cell, visits)``: the home cell and the other cells where a neighbour may lie."""
    slack = math.sqrt(max(0.0, 1 - how.threshold**2)) + 1e-9
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T))

    def run(batches):
        for frame in batches:
            if not len(frame):
                continue
            likeness = _matrix(frame["unit"]) @ centroids.T
            home = likeness.argmax(axis=1)
            near = likeness.max(axis=1)[:, None] - likeness <= slack * apart[home]
            near[np.arange(len(frame)), home] = False
            yield pd.DataFrame({"vec": frame["vec"], "unit": frame["unit"], "cell": home.astype(np.int64), "visits": [np.flatnonzero(x).astype(np.int64) for x in near]})

    return vectors.select("vec", "unit").mapInPandas(run, "vec long, unit array<double>, cell long, visits array<long>")


def _blocked(located: DataFrame, how: Cells) -> tuple[DataFrame, DataFrame]:
    """The vectors with their block, and the blocks ``(cell, blocks)`` of each cell."""
    sizes = located.groupBy("cell").agg(F.ceil(F.count("*") / how.block).cast("long").alias("blocks"))
    held = located.join(F.broadcast(sizes), "cell")  # at most ``most_cells`` rows
    return held.withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks"))), sizes


def links(vectors: DataFrame, centroids: np.ndarray, how: Cells) -> DataFrame:
    """``(a, b, n)``: vector a links with n others in one pair of blocks; b is the smallest of its component there."""
    placed, sizes = _blocked(stored(_located(vectors, centroids, how), "cells"), how)
    table = F.map_from_entries(F.collect_list(F.struct("cell", "blocks")))
    placed = placed.crossJoin(F.broadcast(sizes.agg(table.alias("table"))))  # one row of at most ``most_cells`` entries
    partners = F.flatten(
        F.transform(
            F.concat(F.array("cell"), "visits"),
            lambda c: F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce(F.element_at("table", c), F.lit(0).cast("long"))), lambda b: F.struct(c.alias("cell"), b.alias("block"))),
        )
    )
    real = F.filter(partners, lambda p: p["block"] < F.coalesce(F.element_at("table", p["cell"]), F.lit(0).cast("long")))
    own = F.struct("cell", "block")
    sent = placed.select("vec", "unit", own.alias("own"), F.explode(real).alias("other"))
    keyed = sent.select("vec", "unit", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") <= F.col("other")).alias("first"))

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        alike = key[0] == key[1]
        left = frame if alike else frame[frame["first"]]
        right = frame if alike else frame[~frame["first"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        rows, columns = left["vec"].to_numpy(np.int64), right["vec"].to_numpy(np.int64)
        linked = _matrix(left["unit"]) @ _matrix(right["unit"]).T >= how.threshold
        if alike:
            np.fill_diagonal(linked, False)
        counts = pd.concat([pd.Series(linked.sum(axis=1), rows), *([] if alike else [pd.Series(linked.sum(axis=0), columns)])])
        edges = _forest(linked, rows, columns)
        counts = counts[counts > 0]
        made = [(int(v), int(v), int(n)) for v, n in counts.items()] + [(a, b, 0) for a, b in edges]
        return pd.DataFrame(made, columns=["a", "b", "n"]).astype("int64")

    return keyed.groupBy("x", "y").applyInPandas(compare, T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "n")]))


def near_duplicates(rows: DataFrame, how: Cells = Cells(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:  # noqa: B008
    """``(id_column, n_links, component_id, kept)`` of each row; ids are whole numbers.

    Vectors are linked at a cosine of ``threshold`` or more, in double precision. Null, empty and zero vectors and those with
    null or non-finite components link with nothing, as do rows with a null id, which are kept with a null component.
    Rows that repeat under one id each link with the others and share their counts. ``component_id`` is the smallest id
    reachable, ``kept`` marks it. All sound vectors must have one length. An empty table gives no rows; other columns
    are ignored.
    """
    spark: SparkSession = rows.sparkSession
    units = stored(unit_vectors(rows, id_column, vector_column), "units")
    sound = units.filter("sound and vec is not null")
    count = sound.count()
    if count == 0:
        none = spark.createDataFrame([], "a long, b long, n long")
        found = none
    else:
        place = F.pmod(F.xxhash64("vec"), F.lit(1 << 30))  # those below a cut are about as many as the sample, each id once
        near = sound.filter(place < F.lit(int(min(1.0, how.sample / count) * (1 << 30)))).dropDuplicates(["vec"])
        picked = near.orderBy(F.xxhash64("vec")).select("unit").toPandas()
        cells = int(min(how.most_cells, max(1, count // how.block), len(picked)))
        found = stored(links(sound, spherical_k_means(_matrix(picked["unit"]), cells, how.rounds), how), "links")
    totals = found.groupBy(F.col("a").alias("vec")).agg(F.sum("n").alias("n_links"))
    labels = components(found.select("a", "b")).withColumnRenamed("node", "vec")
    whole = units.select("vec").join(totals, "vec", "left").join(labels, "vec", "left")
    component = F.coalesce("component", "vec")
    return whole.select(
        F.col("vec").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec"), F.lit(True)).alias("kept"),
    )

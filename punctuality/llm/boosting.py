"""Small gradient-boosted trees for binary labels, sent to tasks as plain arrays.

Trees grow from histograms: for each node of a level the sums of gradients and weights in each bin of each feature. These
add up, so :func:`fit_counted` takes them from a table of any size, one grouped sum a level, and the driver sees a few
thousand sums. Gradients are whole numbers of 1 / ``ONE``, so the trees do not depend on how the table is partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 32
ONE = 1 << 24
#: Values are rounded to multiples of 1 / GRID where cuts are sought, and scores cut off to 1 / SCORES, which bounds how many differ.
GRID, SCORES = 1 << 10, 1 << 20


@dataclass
class BoostedTrees:
    """Complete trees of one depth. ``feature`` and ``cut`` have a row for each tree, ``leaf`` holds the outputs."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            out += leaf[node - (2**self.depth - 1)]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(rows)))


#: Sums of gradients and of weights, each by node of the level, feature and bin: of the trees so far, the features and cuts
#: of the tree that grows, and the level.
Histogram = Callable[[BoostedTrees, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


def _binned(rows: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """How many cuts of its feature each value lies above."""
    return np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _sums(model: BoostedTrees, feature: np.ndarray, cut: np.ndarray, level: int, bins: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The histogram of some binned rows, each of which stands for a number of equal ones."""
    p = model.probability(bins)
    gradient, weight = (np.rint(x * ONE) * counts for x in (labels - p, p * (1 - p)))
    every, node = np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
    for _ in range(level):
        node = 2 * node + 1 + (bins[every, feature[node]] > cut[node])
    place = (node - (2**level - 1)) * BINS
    shape = 2**level, BINS
    sums = [[np.bincount(place + bins[:, f], x, shape[0] * BINS).reshape(shape) for f in range(bins.shape[1])] for x in (gradient, weight)]
    return tuple(np.stack(x, axis=1).astype(np.int64) for x in sums)


def _grown(histogram: Histogram, cuts: Sequence[np.ndarray], share: float, trees: int, depth: int, rate: float, least_weight: float) -> BoostedTrees:
    """Newton boosting of the logistic loss; equal gains go to the earlier feature and cut. Bins are told apart while it grows."""
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    inner = 2**depth - 1
    none = np.zeros((0, inner), dtype=np.int64)
    model = BoostedTrees(float(np.log(share / (1 - share))), depth, none, none, np.zeros((0, inner + 1)))
    for _ in range(trees):
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, BINS)
        leaf = np.zeros(inner + 1)
        for level in range(depth):
            every_g, every_w = (x / ONE for x in histogram(model, feature, cut, level))
            for n in range(2**level):
                at = 2**level - 1 + n
                g, w = every_g[n, 0].sum(), every_w[n, 0].sum()
                whole, best, sides = g**2 / (w + 1), 1e-6, ((g, w), (0.0, 0.0))
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    left_g, left_w = np.cumsum(every_g[n, f])[: len(c)], np.cumsum(every_w[n, f])[: len(c)]
                    gain = left_g**2 / (left_w + 1) + (g - left_g) ** 2 / (w - left_w + 1) - whole
                    gain[(left_w < least_weight) | (w - left_w < least_weight)] = 0
                    if gain.max() > best:
                        k = gain.argmax()
                        best, feature[at], cut[at] = gain[k], f, k
                        sides = (left_g[k], left_w[k]), (g - left_g[k], w - left_w[k])
                if level == depth - 1:
                    leaf[2 * n : 2 * n + 2] = [rate * sg / (sw + 1) for sg, sw in sides]
        model = BoostedTrees(model.base, depth, np.vstack([model.feature, feature]), np.vstack([model.cut, cut]), np.vstack([model.leaf, leaf]))
    return model


def _on_values(model: BoostedTrees, cuts: Sequence[np.ndarray]) -> BoostedTrees:
    """The trees for values in place of bins."""
    limits = [[cuts[f][k] if k < BINS else np.inf for f, k in zip(*tree, strict=True)] for tree in zip(model.feature, model.cut, strict=True)]
    return BoostedTrees(model.base, model.depth, model.feature, np.array(limits), model.leaf)


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, least_weight: float = 1.0) -> BoostedTrees:
    """Trees of rows in memory, over ``BINS`` quantile bins."""
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    bins, once = _binned(rows, cuts), np.ones(len(rows))
    histogram = lambda *state: _sums(*state, bins, labels, once)
    return _on_values(_grown(histogram, cuts, labels.mean(), trees, depth, rate, least_weight), cuts)


def quantile_cuts(rows: DataFrame, features: int) -> list[np.ndarray]:
    """The cuts of ``BINS`` quantile bins of each feature over all rows ``(row array<double>, n)``, each of which counts ``n`` times."""
    shares = [i / BINS for i in range(1, BINS)]
    value = lambda f: F.round(F.get("row", F.lit(f)) * GRID) / GRID
    found = rows.agg(*[F.percentile(value(f), shares, F.col("n")) for f in range(features)]).first()
    return [np.unique(np.array(f)) for f in found]


def counted(rows: DataFrame, cuts: Sequence[np.ndarray], *kept: str) -> DataFrame:
    """``(bins binary, *kept, n)``: how often rows ``(row, *kept, n)`` fall into the same bins of all features."""
    names = [*kept, "n"]
    rows = rows.select("row", *names)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                values = part.column(0).flatten().to_numpy().reshape(part.num_rows, len(cuts))
                bins = pa.array([b.tobytes() for b in _binned(values, cuts)], pa.binary())
                yield pa.RecordBatch.from_arrays([bins, *part.columns[1:]], names=["bins", *names])

    return rows.mapInArrow(run, f"bins binary, {layout}").groupBy("bins", *kept).agg(F.sum("n").alias("n"))


def _bins_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def fit_counted(
    rows: DataFrame, cuts: Sequence[np.ndarray], trees: int = 40, depth: int = 3, rate: float = 0.3, least_weight: float = 1.0
) -> BoostedTrees:
    """Trees of all of ``rows`` ``(bins, label, n)``, as :func:`counted` gives them: the same as of every row in memory.

    The rows are read once a level of each tree, so they should be stored.
    """
    rows = rows.select("bins", "label", "n")

    def histogram(model: BoostedTrees, feature: np.ndarray, cut: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        shape = 2**level, len(cuts), BINS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gradient, weight = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
            for part in batches:
                if part.num_rows:
                    labels, counts = (part.column(c).to_numpy().astype(float) for c in (1, 2))
                    g, w = _sums(model, feature, cut, level, _bins_of(part.column(0)), labels, counts)
                    gradient += g
                    weight += w
            cells = np.flatnonzero((gradient != 0) | (weight != 0))
            columns = [pa.array(cells), pa.array(gradient.flat[cells]), pa.array(weight.flat[cells])]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "g", "w"])

        found = rows.mapInArrow(run, "cell long, g long, w long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("w").alias("w")).toArrow()
        sums = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        for held, name in zip(sums, ("g", "w"), strict=True):
            held.flat[found["cell"].to_numpy()] = found[name].to_numpy()
        return sums

    share = rows.agg(F.sum(F.col("label") * F.col("n")) / F.sum("n")).first()[0]
    return _on_values(_grown(histogram, cuts, share, trees, depth, rate, least_weight), cuts)


def thresholds_of(
    rows: DataFrame, cuts: Sequence[np.ndarray], trees: BoostedTrees, by: str, precision: float, default: float
) -> dict[int, float]:
    """:func:`threshold_for` for each value of ``by``, from all of ``rows`` ``(bins, by, label, n)``; values without one are left out.

    Scores are cut off to multiples of 1 / ``SCORES``; these are counted, and the counts are summed up from the highest on.
    """
    # A row's bins decide its side of each cut, and so does any value between the cuts around its bin.
    inside = [np.append(c, np.inf) if len(c) else np.zeros(1) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                bins = _bins_of(part.column(0))
                values = np.stack([inside[f][bins[:, f]] for f in range(len(cuts))], axis=1)
                score = np.floor(trees.probability(values) * SCORES).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(score), part.column(2), part.column(3)], names=["by", "score", "label", "n"])

    scored = rows.select(F.col(by).cast("long"), "bins", F.col("label").cast("long"), F.col("n").cast("long")).select("bins", by, "label", "n")
    right = F.sum(F.col("label") * F.col("n")).alias("right")
    found = scored.mapInArrow(run, "by long, score long, label long, n long").groupBy("by", "score").agg(right, F.sum("n").alias("n"))
    higher = Window.partitionBy("by").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    good = found.withColumn("share", F.sum("right").over(higher) / F.sum("n").over(higher)).filter(F.col("share") >= precision)
    return {r.by: max(default, r.score / SCORES) for r in good.groupBy("by").agg(F.min("score").alias("score")).collect()}


def threshold_for(scores: np.ndarray, labels: np.ndarray, precision: float, default: float) -> float:
    """The smallest score from which on at least ``precision`` of held-out rows are positive; ``default`` if none is."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    last = np.append(scores[order][1:] != scores[order][:-1], True)
    good = np.flatnonzero((right >= precision) & last)
    return max(default, float(scores[order][good[-1]])) if len(good) else default

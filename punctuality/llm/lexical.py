"""Ranked lexical search: best-first intervals of documents, bounded by range maxima of posting lists.

A pass over the documents counts the terms that the items use and stores one row a document: its length and its counts. Each
task then reads documents in shards. In a shard every term has a posting list in the order of document ids with the impact of each
posting, and over all lists lies a sparse table that gives the place of the greatest impact of any part of a list by two look-ups.

An item is answered shard by shard. The whole shard is one interval, bounded by the sum, over the item's terms, of the greatest
impact within it. The intervals of the highest bounds are taken, each is split at the document of its single greatest
contribution, that document is scored exactly, and the parts to its left and right get bounds of their own. No interval is
taken whose bound lies below the score of the k-th best document found so far, in this shard or any before it in the task, so the
result is exact. The best k of the tasks meet in a last top-k by item.

Items are dealt to blocks of bounded size, each of which is a search of its own over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from punctuality.llm.common import plain_terms, slices, stored

#: Text of the items that are sent to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Postings and documents of a shard; a single document may go beyond.
SHARD_POSTINGS, SHARD_DOCUMENTS = 1 << 19, 1 << 14
#: Intervals split at once: few at first, where the best are found, then more and more.
FIRST_WAVE, MOST_WAVE = 4, 256


@dataclass(frozen=True)
class Ranking:
    """``k`` documents an item; ``share`` of a hundred of the length's influence, ``slope`` of the term count's."""

    k: int = 10
    share: int = 75
    slope: int = 8
    unit: int = 1000


def terms_of(text: str | None) -> list[str]:
    """The terms of one text in their order."""
    part = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], names=["text"])
    return plain_terms(part, 0)[0].as_py().split()


def term_counts(docs: DataFrame, vocabulary: list[str], id_column: str, text_column: str) -> DataFrame:
    """``(id, n, terms, tf)`` of each row: number of all its terms, which of ``vocabulary`` it has (by place) and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for part in slices(batches):
            lists = pc.ascii_split_whitespace(plain_terms(part))
            flat = lists.flatten()
            real = pc.greater(pc.binary_length(flat), 0)
            ends = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)))
            edges = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            coded = flat.filter(real).dictionary_encode()
            place = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            uses = place[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(part.num_rows), np.diff(edges))
            wanted = uses >= 0
            pairs, tf = np.unique(row[wanted] * max(len(vocabulary), 1) + uses[wanted], return_counts=True)
            held = pairs // max(len(vocabulary), 1)
            offsets = pa.array(np.searchsorted(held, np.arange(part.num_rows + 1)), pa.int32())
            columns = [part.column(0), pa.array(np.diff(edges), pa.int64())]
            columns += [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (pairs % max(len(vocabulary), 1), tf)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tf"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema[0].dataType.simpleString()}, n long, terms array<int>, tf array<int>")


class Postings:
    """Posting lists of a shard: term, document (by place in ascending order of ids) and impact, and their range maxima."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, documents: int) -> None:
        order = np.lexsort((doc, term))
        term, self.doc, self.impact = term[order].astype(np.int64), doc[order].astype(np.int64), impact[order]
        self.width = documents + 1
        self.key = term * self.width + self.doc
        longest = int(np.bincount(term).max()) if len(term) else 0
        self.levels = [np.arange(len(term), dtype=np.int32)]
        for level in range(1, longest.bit_length()):
            last, half = self.levels[-1], 1 << (level - 1)
            left, right = last[:-half], last[half:]
            best = last.copy()
            best[: len(left)] = np.where(self.impact[right] > self.impact[left], right, left)
            self.levels.append(best)
        self.table = np.stack(self.levels) if len(term) else np.zeros((1, 0), np.int32)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the lists of ``terms``."""
        return np.searchsorted(self.key, terms * self.width), np.searchsorted(self.key, (terms + 1) * self.width)

    def find(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each document (rows) and term (columns) the first posting of the term at the document or after it."""
        return np.searchsorted(self.key, terms[None, :] * self.width + docs[:, None])

    def peaks(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each part of a list, -1 where the part is empty."""
        sizes = ends - starts
        filled = sizes > 0
        level = np.frexp(np.maximum(sizes, 1))[1] - 1
        start = np.where(filled, starts, 0)
        left = self.table[level, start]
        right = self.table[level, np.where(filled, ends - (1 << level), 0)]
        return np.where(filled, np.where(self.impact[right] > self.impact[left], right, left), -1)


@dataclass
class Best:
    """The best k of an item so far, as ``(score, id)`` in the order of the result."""

    k: int
    rows: list[tuple[int, object]] = field(default_factory=list)

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows = sorted([*self.rows, *zip(scores.tolist(), ids, strict=True)], key=_placed)[: self.k]

    @property
    def full(self) -> bool:
        return len(self.rows) == self.k


def _placed(row: tuple[int, object]) -> tuple:
    """Highest scores first, then ascending ids, null ids last."""
    return -row[0], row[1] is None, row[1] if row[1] is not None else 0


def search(postings: Postings, ids: list, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Put the documents of a shard that belong into ``best`` there; returns how many were scored.

    ``ids`` are ascending, nulls last. Bounds that equal the k-th score are followed only where a smaller id may come.
    """
    starts, ends = postings.lists(terms)
    some = ends > starts
    terms, times, starts, ends = terms[some], times[some], starts[some], ends[some]
    if not len(terms):
        return 0

    def bounded(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval and the document of its greatest single contribution."""
        peak = postings.peaks(starts, ends)
        worth = np.where(peak >= 0, postings.impact[peak] * times, 0)
        chosen = peak[np.arange(len(peak)), worth.argmax(1)]
        return worth.sum(1), np.where(chosen >= 0, postings.doc[chosen], -1)

    low = np.zeros(1, np.int64)
    starts, ends = starts[None, :], ends[None, :]
    bound, split = bounded(starts, ends)
    wave, scored = FIRST_WAVE, 0
    while len(bound):
        alive = bound > 0
        if best.full:
            least, last = best.rows[-1][0], best.rows[-1]
            alive &= bound >= least
            for at in np.flatnonzero(alive & (bound == least)):
                alive[at] = _placed((least, ids[low[at]])) < _placed(last)
        if not alive.all():
            low, starts, ends, bound, split = (x[alive] for x in (low, starts, ends, bound, split))
            if not len(bound):
                break
        if len(bound) > wave:
            order = np.argpartition(-bound, wave)
            taken, rest = order[:wave], order[wave:]
        else:
            taken, rest = np.arange(len(bound)), np.zeros(0, np.int64)
        a, b, doc = starts[taken], ends[taken], split[taken]
        at = np.clip(postings.find(terms, doc), a, b)
        inside = np.minimum(at, len(postings.doc) - 1)
        has = (at < b) & (postings.doc[inside] == doc[:, None])
        score = (np.where(has, postings.impact[inside], 0) * times).sum(1)
        scored += len(doc)
        found = score > 0
        best.add(score[found], [ids[d] for d in doc[found]])
        new_starts, new_ends = np.concatenate((a, at + has)), np.concatenate((at, b))
        new_low = np.concatenate((low[taken], doc + 1))
        new_bound, new_split = bounded(new_starts, new_ends)
        low, bound, split = np.concatenate((low[rest], new_low)), np.concatenate((bound[rest], new_bound)), np.concatenate((split[rest], new_split))
        starts, ends = np.concatenate((starts[rest], new_starts)), np.concatenate((ends[rest], new_ends))
        wave = min(2 * wave, MOST_WAVE)
    return scored


@dataclass
class Statistics:
    """What a block's search sends to its tasks: terms and their repeats of each item, term weights, N and L of the corpus."""

    items: list[tuple[np.ndarray, np.ndarray]]
    weight: np.ndarray
    documents: int
    uses: int


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of stored counts, as many as make up a shard."""
    held, postings, documents = [], 0, 0
    for batch in batches:
        at = 0
        sizes = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            fits = int(np.searchsorted(sizes, before + SHARD_POSTINGS - postings, side="right"))
            end = max(min(fits, at + SHARD_DOCUMENTS - documents, batch.num_rows), at + (not held))
            if end > at:
                held.append(batch.slice(at, end - at))
                postings += int(sizes[end - 1]) - before
                documents += end - at
                at = end
            if at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, postings, documents = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _postings(shard: pa.Table, known: Statistics, rule: Ranking) -> tuple[Postings, list]:
    """Posting lists with impacts of a shard, and its ids in ascending order. All impacts are 64-bit whole numbers."""
    shard = shard.combine_chunks().sort_by([("id", "ascending")])
    n = shard["n"].to_numpy()
    lists = shard["terms"].combine_chunks()
    term, tf = lists.flatten().to_numpy().astype(np.int64), shard["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(shard.num_rows), np.diff(lists.offsets.to_numpy()))
    m = 100 - rule.share + (rule.share * n * known.documents) // max(known.uses, 1)
    impact = known.weight[term] * ((1_000_000_000 * tf) // (rule.unit * tf + rule.slope * m[doc]))
    return Postings(term, doc, impact, shard.num_rows), shard["id"].to_pylist()


def _answered(counts: DataFrame, known: Statistics, rule: Ranking) -> DataFrame:
    """``(item, id, score)``: the best of each task for each item of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = [Best(rule.k) for _ in known.items], pa.null()
        for shard in _shards(batches):
            kind = shard.schema.field("id").type
            postings, ids = _postings(shard, known, rule)
            for (terms, times), own in zip(known.items, best, strict=True):
                search(postings, ids, terms, times, own)
        rows = [(item, document, score) for item, own in enumerate(best) for score, document in own.rows]
        if not rows:
            return
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"])

    return counts.mapInArrow(run, f"item int, id {counts.schema['id'].dataType.simpleString()}, score long")


def _search_block(docs: DataFrame, block: list, rule: Ranking, id_column: str, text_column: str) -> DataFrame | None:
    """``(item, id, score, rank)`` for the items of a block, by their place in it; None if no item has a term."""
    split = [terms_of(text) for text in block]
    vocabulary = sorted({term for own in split for term in own})
    if not vocabulary:
        return None
    place = {term: k for k, term in enumerate(vocabulary)}
    seen = Observation()
    held = term_counts(docs, vocabulary, id_column, text_column)
    facts = (F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("documents"), F.sum("n").alias("uses"))
    counts = stored(held.observe(seen, *facts).filter(F.size("terms") > 0), "postings")
    documents, uses = seen.get["documents"] or 0, seen.get["uses"] or 0
    weight = np.array([math.floor(1000 * math.log(2 * documents + 2))] * len(vocabulary), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        weight[r.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r.df + 1)))
    items = []
    for own in split:
        terms, times = np.unique(np.array([place[term] for term in own], np.int64), return_counts=True)
        items.append((terms, times.astype(np.int64)))
    found = _answered(counts, Statistics(items, weight, documents, uses), rule)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rule.k)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    rule: Ranking = Ranking(),
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of each row of ``items``, scores above 0 only.

    Equal scores go by ascending id, null ids last. Null, empty and termless texts match nothing and, as documents, count for
    nothing. Rows of ``items`` that repeat an id are searched each; repeated documents are ranked each. Empty tables give no
    rows; other columns are ignored, whatever their names. The items are read to the driver a block at a time.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_column).alias("item_id"), F.col(text_column).alias("text")).filter("text is not null")
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    blocks = -(-size // BLOCK_BYTES)
    kind, own_kind = items.schema[item_column].dataType.simpleString(), docs.schema[id_column].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, id {own_kind}, score long")
    for number in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        found = _search_block(docs, [r.text for r in block], rule, id_column, text_column)
        if found is not None:
            names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(block)], f"item int, item_id {kind}")
            out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score"))
    return out.withColumnRenamed("id", id_column)

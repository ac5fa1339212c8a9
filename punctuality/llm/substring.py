"""Removal of passages that repeat word for word, by counting windows in blocks that anchors cut.

This replaces the factor parse of Relative Lempel-Ziv: nothing is parsed greedily and no factor has a source. What goes is
every word of a window found twice, which counts by key give exactly, without looking up a reference from each place.

A repeat is a run of ``window`` words that also starts anywhere else. The corpus itself is the reference:

1. **Blocks.** Each window picks one anchor inside it, the ``SEED``-word run with the smallest hash (leftmost among
   equals). The choice depends on the window's words alone, so equal windows pick the same anchor at the same place.
   Consecutive windows with one anchor form a block; blocks cut a document at about every thirteenth word, and equal
   passages are cut equally wherever they stand.
2. **Index.** Every block of every document is a reference block. A block is named by its anchor and a fingerprint
   of its words, together 128 bits. An anchor that occurs once rules out all its windows at once.
3. **Whole blocks.** All windows of a block that is found elsewhere as a whole are repeats.
4. **Mixed blocks.** Where a repeat begins or ends inside a block, the block's anchor is known elsewhere with
   other words around it. Only there are single windows compared, by 128-bit fingerprints.

Everything travels as counts by key: a block that holds a third of all rows is summed before it is shuffled, and no
group is ever collected. The text itself is shuffled once and reused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import slices, spans_of, split_words

WINDOW = 35
SEED = 10
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_ODD, _ODD2 = int(_A) | 1, int(_B) | 1
WORDS = re.compile("[^\x20\x09-\x0d]+")
#: Kinds of blocks after the index was asked.
WHOLE, MIXED = 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C
    return x ^ (x >> np.uint64(29))


def _word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each distinct word."""
    held = words.cast(pa.binary()).to_pylist()
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in held]), dtype=">u8").astype(np.uint64)
    return both[0::2], both[1::2]


def _powers(odd: int, count: int) -> np.ndarray:
    out = np.full(count, odd, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Rolling:
    """Fingerprints of any run of words by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, values: np.ndarray, odd: int):
        self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(odd, len(values)), dtype=np.uint64)))
        self._back = _powers(pow(odd, -1, 1 << 64), len(values) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self._sums[end] - self._sums[start]) * self._back[start])


class _Parsed:
    """Windows, anchors and blocks of one slice of documents."""

    def __init__(self, part: pa.RecordBatch, window: int, seed: int):
        words, codes, self.counts = split_words(part)
        first, second = _word_hashes(words)
        self.words, self.codes = words, codes
        self.starts, self.ends = spans_of(self.counts)
        self.one, self.two = _Rolling(first[codes], _ODD), _Rolling(second[codes], _ODD2)
        windows = np.maximum(self.counts - window + 1, 0)
        total = int(windows.sum())
        #: First word of each window, over all words of the slice, and its document.
        self.doc = np.repeat(np.arange(len(self.counts)), windows)
        place = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
        self.at = place + self.starts[self.doc]
        self.place = place
        self.anchor = self._anchors(len(codes), window, seed)[self.at] if total else np.zeros(0, np.int64)
        new = np.ones(total, dtype=bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.block = np.flatnonzero(new)
        self.size = np.diff(np.append(self.block, total))
        block_at = self.at[self.block]
        spot = self.anchor[self.block]
        self.key = self.one(spot, spot + seed)
        #: The fingerprint also holds where the anchor stands, as windows at other distances are never the same.
        name = self.two(block_at, block_at + self.size + window - 1)
        self.print = _mixed(name ^ ((spot - block_at).astype(np.uint64) * _A))

    def _anchors(self, total: int, window: int, seed: int) -> np.ndarray:
        """For each word: where the smallest seed of the window that starts there begins."""
        where = np.arange(max(total - seed + 1, 0))
        value = self.one(where, where + seed)
        width, span = 1, window - seed + 1
        while width < span:
            step = min(width, span - width)
            right, at = value[step:], where[step:]
            take = right < value[: len(right)]
            value = np.where(take, right, value[: len(right)])
            where = np.where(take, at, where[: len(at)])
            width += step
        return where


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _id_type(rows: DataFrame) -> str:
    return rows.schema[0].dataType.simpleString()


def blocks(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """``(row_key, anchor, print, first, windows)`` of each block of ``docs(id, text, row_key)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            held = _Parsed(part, window, seed)
            doc = held.doc[held.block]
            yield pa.RecordBatch.from_arrays(
                [part.column(2).take(pa.array(doc)), _signed(held.key), _signed(held.print), pa.array(held.place[held.block]), pa.array(held.size)],
                names=["row_key", "anchor", "print", "first", "windows"],
            )

    return docs.mapInArrow(run, "row_key long, anchor long, print long, first long, windows long")


def boundary_windows(found: DataFrame, window: int, seed: int) -> DataFrame:
    """``(row_key, w1, w2, place)`` of each window in a mixed block of ``found(id, text, row_key, factors)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            held = _Parsed(part, window, seed)
            first, kind, doc = _listed(part.column(3))
            wanted = held.starts[doc] + first
            mixed = np.isin(held.at[held.block], wanted[kind == MIXED])
            chosen = np.repeat(mixed, held.size)
            at, rows = held.at[chosen], held.doc[chosen]
            yield pa.RecordBatch.from_arrays(
                [part.column(2).take(pa.array(rows)), _signed(held.one(at, at + window)), _signed(held.two(at, at + window)), pa.array(held.place[chosen])],
                names=["row_key", "w1", "w2", "place"],
            )

    return found.mapInArrow(run, "row_key long, w1 long, w2 long, place long")


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, length or kind, and row number of packed entries; a null list is empty."""
    sizes = np.array([len(x) if x is not None else 0 for x in column.to_pylist()], dtype=np.int64)
    flat = column.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64)
    return flat >> 8, flat & 255, np.repeat(np.arange(len(sizes)), sizes)


def _packed(first: str, value: Column) -> Column:
    """A window's number and a small number beside it in one long."""
    return F.shiftleft(F.col(first), 8) + value


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``docs(id, text, row_key)`` with ``covered``: runs of repeated windows as packed (first, windows) longs.

    The blocks of a document found elsewhere as a whole, together with the windows of mixed blocks that are counted
    twice, cover exactly the words of repeated windows.
    """
    found = blocks(docs, window, seed)
    index = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("print").alias("lo"), F.max("print").alias("hi"))
        .filter("n > 1").select("anchor", F.when(F.col("lo") == F.col("hi"), WHOLE).otherwise(MIXED).alias("kind"))
    )
    placed = found.join(index, "anchor").select("row_key", "kind", "first", "windows")
    whole = placed.filter(F.col("kind") == WHOLE).select("row_key", _packed("first", F.col("windows")).alias("run"))
    mixed = placed.filter(F.col("kind") == MIXED).groupBy("row_key").agg(F.collect_list(_packed("first", F.col("kind"))).alias("factors"))
    windows = boundary_windows(docs.join(mixed, "row_key").select(*docs.columns, "factors"), window, seed)
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    single = windows.join(twice, ["w1", "w2"]).select("row_key", _packed("place", F.lit(1)).alias("run"))
    covered = whole.unionByName(single).groupBy("row_key").agg(F.collect_list("run").alias("covered"))
    return docs.join(covered, "row_key", "left").select(*docs.columns, "covered")


def _kept(part: pa.RecordBatch, window: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, all words as numbers, words of each row, whether each word stays, and starts of the rows."""
    words, codes, counts = split_words(part)
    starts, _ = spans_of(counts)
    first, size, doc = _listed(part.column(3))
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    begin = starts[doc] + first
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + size + window - 1, -1)
    return words, codes, counts, np.cumsum(edge[:-1]) == 0, starts


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(id_column, text_column, F.monotonically_increasing_id().alias("row_key"))


def deduplicate(docs: DataFrame, window: int = WINDOW, seed: int = SEED, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256, kept_text)`` of each row of ``docs``.

    Words are runs of anything but space and U+0009 to U+000D. Each word covered by a run of ``window`` words that
    also starts anywhere else in the corpus, the same document included, is removed; ``kept_text`` joins the others
    by one space. The table is read more than once and must be the same each time, as a stored one is. Null and empty texts, and texts of fewer words than a window, keep all they have. Rows that repeat
    as a whole (also under one id, or under a null id) repeat each other. An empty table gives no rows; columns other
    than id and text are ignored.
    """
    if not 1 <= seed <= window <= 255 + seed:
        raise ValueError("needs 1 <= seed <= window, and at most 256 windows in a block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words, codes, counts, keep, starts = _kept(part, window)
            removed = np.zeros(len(counts), dtype=np.int64)
            some = counts > 0
            removed[some] = np.add.reduceat((~keep).astype(np.int64), starts[some]) if some.any() else 0
            kept = words.take(pa.array(codes[keep]))
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts - removed))), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), " ")
            shas = [hashlib.sha256(text or b"").hexdigest() for text in joined.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts), pa.array(removed), pa.array(shas), joined],
                names=[id_column, "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    rows = _keyed(docs, id_column, text_column)
    return repeats(rows, window, seed).mapInArrow(
        run, f"`{id_column}` {_id_type(rows)}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, text_column: str = "text") -> DataFrame:
    """``docs`` with all its columns, and without the words that ``deduplicate`` removes.

    What stands between two removed runs stays as it is, white space included; texts without a repeat, null and empty
    ones do not change.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            changed = []
            runs, size, doc = _listed(part.column(2))
            own = {}
            for first, n, row in zip(runs.tolist(), size.tolist(), doc.tolist(), strict=True):
                own.setdefault(row, []).append((first, first + n + window - 1))
            for row, text in enumerate(part.column(0).to_pylist()):
                changed.append(_cut_out(text, own[row]) if row in own else text)
            yield pa.RecordBatch.from_arrays([pa.array(changed, pa.string()), part.column(1)], names=["text", "row_key"])

    keyed = docs.withColumn("__row_key", F.monotonically_increasing_id())
    rows = keyed.select(F.lit(None).cast("long").alias("id"), F.col(text_column).alias("text"), F.col("__row_key").alias("row_key"))
    found = repeats(rows, window, seed).filter("covered is not null").select("text", "row_key", "covered")
    cleaned = found.mapInArrow(run, "text string, row_key long").toDF("__cleaned", "__row_key")
    joined = keyed.join(cleaned, "__row_key", "left")
    text = F.coalesce("__cleaned", F.col(text_column))
    return joined.withColumn(text_column, text).select(*[F.col(f"`{c}`") for c in docs.columns])


def _cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the given spans of word numbers."""
    words = [m.span() for m in WORDS.finditer(text)]
    out, at, end_word = [], 0, 0
    for first, end in sorted(spans):
        first = max(first, end_word)
        if end > first:
            out.append(text[at : words[first][0]])
            at, end_word = words[end - 1][1], end
    return "".join([*out, text[at:]])

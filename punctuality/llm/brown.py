"""Brown class n-grams: words in classes, transitions between classes and emissions of words.

p(w_i | w_{i-1}) = p(c_i | c_{i-1}) p(w_i | c_i), each smoothed, over the words of a text and one end.

**Seed classes.** The ``TYPES`` most frequent words are types of their own; every other word begins with the type of its
last two letters, hashed to ``TAILS`` types. Bigrams of types are counted over the whole training text, and exchange
clustering moves each type to the class that raises the bigram likelihood most, again and again.
**Classes of words.** Then every other word of the training text gets a class of its own: its uses are summed by the
classes at its left and right over all texts, and tasks give it the class that suits these best. ``REFINEMENTS`` such
sweeps go over the frequent words, of which the likeliest classes stay; a last one over all others. Only
words never seen in training take the seed class of their ending.
**Emissions.** Words are counted over the whole training text. The counts and classes of at most ``FREQUENT`` words go to
every task. A text is scored there as if all other words were unseen; what its rare words and their neighbours make of
that when their counts and classes are known is found in joins by word, and added. So neither a table of all words nor
the texts themselves are moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import slices, spans_of, split_words, stored

TYPES, TAILS, CLASSES = 1024, 512, 64
#: Words of which tasks hold count and class.
FREQUENT = 100_000
SWEEPS = 12
REFINEMENTS = 2
#: Added to each cell of the class bigrams when words choose among classes.
SMOOTH = 0.5
#: Bins of word counts by doubling, of which the highest that fit make up the frequent words.
BINS = 16
#: Words whose sums a task hands on at once.
TOGETHER = 20_000
ADD = 0.1
#: Weight of the class frequencies within the transitions.
BACK_OFF = 2.0


def _tail_type(word: str) -> int:
    return TYPES + 1 + xxhash.xxh32_intdigest(word[-2:].encode()) % TAILS


def _tail_types(words: pa.Array) -> np.ndarray:
    """:func:`_tail_type` of each word; every ending is hashed once."""
    coded = pc.utf8_slice_codeunits(words, -2).dictionary_encode()
    kinds = np.array([_tail_type(ending) for ending in coded.dictionary.to_pylist()], dtype=np.int64)
    return kinds[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)


@dataclass
class Types:
    """Numbers of types: 0 is the end of a text, then the frequent words by rank, then the tails."""

    rank: dict[str, int]

    @property
    def count(self) -> int:
        return 1 + TYPES + TAILS

    def of(self, words: pa.Array) -> np.ndarray:
        kinds = _tail_types(words)
        ranks = pc.index_in(words, pa.array(list(self.rank), pa.string()))
        known = ranks.is_valid().to_numpy(zero_copy_only=False)
        kinds[known] = np.array(list(self.rank.values()), dtype=np.int64)[ranks.drop_null().to_numpy(zero_copy_only=False)] if known.any() else 0
        return kinds


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``(word, c)`` over all texts, A-Z in lower case; each slice of texts sends a word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            words, codes, _ = split_words(part, 0, lower=True)
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)).astype(np.int64))], names=["word", "c"])

    return docs.select(text_column).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _token_types(part: pa.RecordBatch, types: Types, column: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, codes, counts of a slice, and types of its words with the end of each text before and after it."""
    words, codes, counts = split_words(part, column, lower=True)
    kinds = types.of(words)[codes] if len(words) else np.zeros(0, np.int64)
    starts, ends = spans_of(counts)
    rows = len(counts)
    sequence = np.zeros(len(codes) + rows + 1, dtype=np.int64)  # an end before the first text and after each
    place = np.arange(len(codes)) + np.repeat(np.arange(rows), counts) + 1
    sequence[place] = kinds
    return words, codes, counts, sequence, ends + np.arange(rows) + 1


def bigram_counts(docs: DataFrame, types: Types, text_column: str = "text") -> np.ndarray:
    """Counts of adjacent types over all texts, as a matrix of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(types.count * types.count, dtype=np.int64)
        for part in slices(batches, 0):
            sequence = _token_types(part, types, 0)[3]
            held += np.bincount(sequence[:-1] * types.count + sequence[1:], minlength=len(held))
        keys = np.flatnonzero(held)
        for start in range(0, len(keys), 100_000):
            at = keys[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["pair", "n"])

    found = docs.select(text_column).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.zeros(types.count * types.count, dtype=np.float64)
    rows = found.toPandas()  # at most one row for each cell of the matrix
    table[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return table.reshape(types.count, types.count)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(table: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each type. Type 0 stays alone in class 0; types that never occur go to class 1.

    Starts with types dealt to classes in order of frequency; each sweep offers every type every class and takes the best.
    """
    count = len(table)
    uses = table.sum(axis=1) + table.sum(axis=0)
    order = np.argsort(-uses, kind="stable")
    order = order[order != 0]
    home = np.zeros(count, dtype=np.int64)
    home[order] = 1 + np.arange(count - 1) % (classes - 1)
    home[order[uses[order] == 0]] = 1
    order = order[uses[order] > 0]
    member = np.zeros((count, classes))
    member[np.arange(count), home] = 1
    joint = member.T @ table @ member
    out, into = table @ member, table.T @ member  # of each type: to each class, from each class
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, loop = home[w], table[w, w]
            row, column = out[w].copy(), into[w].copy()
            joint[a, :] -= row
            joint[:, a] -= column
            joint[a, a] += loop
            row[a] -= loop
            column[a] -= loop
            left, right = joint.sum(axis=1), joint.sum(axis=0)
            gain = (_xlogx(joint + row) - _xlogx(joint)).sum(axis=1) + (_xlogx(joint.T + column) - _xlogx(joint.T)).sum(axis=1)
            same = np.diag(joint)
            gain += _xlogx(same + row + column + loop) - _xlogx(same + row) - _xlogx(same + column) + _xlogx(same)
            gain -= _xlogx(left + row.sum() + loop) - _xlogx(left) + _xlogx(right + column.sum() + loop) - _xlogx(right)
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            joint[b, :] += row
            joint[:, b] += column
            joint[b, b] += loop
            if b != a:
                moved += 1
                home[w] = b
                out[:, a] -= table[:, w]
                out[:, b] += table[:, w]
                into[:, a] -= table[w]
                into[:, b] += table[w]
        if not moved:
            break
    return home


def frequent_words(counts: DataFrame, most: int) -> tuple[pa.Array, np.ndarray]:
    """The words with the highest counts, most frequent first, and these: as many bins of counts as hold at most ``most`` words.

    Counts of the bins are read first, so the driver never gets more rows than these.
    """
    place = F.floor(F.log2(F.col("c").cast("double")) * BINS)
    bins = sorted(((r.b, r.n) for r in counts.groupBy(place.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    lowest, held = None, 0
    for b, n in bins:
        if held + n > most:
            break
        lowest, held = b, held + n
    chosen = counts.filter(place >= lowest if lowest is not None else F.lit(False)).select("word", "c").toArrow()
    chosen = chosen.sort_by([("c", "descending"), ("word", "ascending")])
    return chosen["word"].combine_chunks().cast(pa.string()), chosen["c"].to_numpy().astype(np.int64)


@dataclass
class Known:
    """The frequent words by rank with their classes, and the class of each type. Sent to tasks."""

    words: pa.Array
    klass: np.ndarray
    home: np.ndarray

    def ranks(self, words: pa.Array) -> np.ndarray:
        """Rank of each word, -1 for rare ones."""
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class _Slice:
    """The words of a slice with their classes; rare words have that of their ending."""

    def __init__(self, part: pa.RecordBatch, column: int, known: Known):
        self.words, self.codes, self.lengths = split_words(part, column, lower=True)
        self.rank = known.ranks(self.words)
        klass = np.zeros(len(self.words), dtype=np.int64)
        rare = np.flatnonzero(self.rank < 0)
        klass[self.rank >= 0] = known.klass[self.rank[self.rank >= 0]]
        klass[rare] = known.home[_tail_types(self.words.take(pa.array(rare)))]
        rows = len(self.lengths)
        self.owner = np.repeat(np.arange(rows), self.lengths)
        self.kinds = klass[self.codes] if len(self.codes) else np.zeros(0, np.int64)
        self.line = self.rank[self.codes] if len(self.codes) else np.zeros(0, np.int64)
        self.spot = np.arange(len(self.codes)) + self.owner + 1
        self.around = np.zeros(len(self.codes) + rows + 1, dtype=np.int64)  # an end before the first text and after each
        self.around[self.spot] = self.kinds

    def beside(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes at the left and at the right of words, given by place."""
        return self.around[self.spot[at] - 1], self.around[self.spot[at] + 1]


def class_bigrams(docs: DataFrame, known: Known, text_column: str = "text") -> np.ndarray:
    """Counts of adjacent classes over all texts, as a matrix of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joint = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for part in slices(batches, 0):
            around = _Slice(part, 0, known).around
            joint += np.bincount(around[:-1] * CLASSES + around[1:], minlength=CLASSES * CLASSES)
        used = np.flatnonzero(joint)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(joint[used])], names=["cell", "n"])

    joint = np.zeros(CLASSES * CLASSES)
    for row in docs.select(text_column).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        joint[row.cell] = row.n
    return joint.reshape(CLASSES, CLASSES)


def _lists(owner: np.ndarray, values: np.ndarray, size: int, kind: pa.DataType) -> pa.ListArray:
    """Values by owner, which ascends, as one list each."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(size + 1)), pa.int32()), pa.array(values, kind))


def sums_beside(docs: DataFrame, known: Known, text_column: str = "text") -> DataFrame:
    """``(rank, uses)``: sums of the frequent words that are no seeds by left class and by CLASSES + right class, as
    n * 2 * CLASSES + class. A partition sends each word once at most."""
    width, many = 2 * CLASSES, max(0, len(known.words) - TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(many * width, dtype=np.int32)
        for part in slices(batches, 0):
            held = _Slice(part, 0, known)
            at = np.flatnonzero(held.line >= TYPES)
            left, right = held.beside(at)
            row = (held.line[at] - TYPES) * width
            np.add.at(cells, row + left, 1)
            np.add.at(cells, row + CLASSES + right, 1)
        used = np.flatnonzero(cells)
        rank = np.unique(used // width)
        lists = _lists(np.searchsorted(rank, used // width), cells[used].astype(np.int64) * width + used % width, len(rank), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(rank + TYPES), lists], names=["rank", "uses"])

    return docs.select(text_column).mapInArrow(run, "rank long, uses array<long>")


def rare_beside(docs: DataFrame, known: Known, text_column: str = "text") -> DataFrame:
    """``(word, uses)`` as in :func:`sums_beside` for all rare words; one row for each word of a slice."""
    width = 2 * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            held = _Slice(part, 0, known)
            at = np.flatnonzero(held.line < 0)
            left, right = held.beside(at)
            base = held.codes[at].astype(np.int64) * width
            cells, n = np.unique(np.concatenate((base + left, base + CLASSES + right)), return_counts=True)
            word = np.unique(cells // width)
            lists = _lists(np.searchsorted(word, cells // width), n * width + cells % width, len(word), pa.int64())
            yield pa.RecordBatch.from_arrays([held.words.take(pa.array(word)), lists], names=["word", "uses"])

    return docs.select(text_column).mapInArrow(run, "word string, uses array<long>")


def _summed(found: DataFrame, key: str, take, layout: str) -> DataFrame:  # noqa: ANN001
    """``take(keys, sums)`` of the rows of ``found`` summed by key: a row of 2 * CLASSES sums for each key.

    Rows come sorted by key and are added up as they come, so a key of many rows takes no more room than one of few.
    """
    width, together = 2 * CLASSES, TOGETHER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros((1, width))
        for batch in batches:
            for start in range(0, batch.num_rows, together):
                part = batch.slice(start, together)
                coded = pc.run_end_encode(part.column(0))
                keys, ends = coded.values, np.asarray(coded.run_ends)
                rows = np.searchsorted(ends, np.arange(part.num_rows), side="right")
                lists = part.column(1)
                uses = lists.flatten().to_numpy(zero_copy_only=False)
                place = np.repeat(rows, np.asarray(lists.value_lengths())) * width + uses % width
                sums = np.bincount(place, uses // width, len(keys) * width).reshape(len(keys), width)
                if last is not None and keys[0].as_py() == last.as_py():
                    sums[0] += held[0]
                elif last is not None:
                    yield take(pa.array([last.as_py()], keys.type), held)
                if len(keys) > 1:
                    yield take(keys.slice(0, len(keys) - 1), sums[:-1])
                last, held = keys[len(keys) - 1], sums[-1:].copy()
        if last is not None:
            yield take(pa.array([last.as_py()], last.type), held)

    return found.repartition(key).sortWithinPartitions(key).mapInArrow(run, layout)


def chosen(own: np.ndarray, left: np.ndarray, right: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """The best class of each word, given its class and its uses by left and right class, all others left as they are.

    The likelihood of a word's bigrams in each class; in its own, its bigrams are taken out of the class first.
    """
    rows, into = joint.sum(axis=1) + SMOOTH * CLASSES, joint.sum(axis=0) + SMOOTH * CLASSES
    worth = np.log(joint + SMOOTH) - np.log(rows)[:, None] - np.log(into)[None, :]
    gain = left @ worth + right @ worth.T
    n = left.sum(axis=1, keepdims=True)
    least = SMOOTH / 2
    before = np.log(np.maximum(joint[:, own].T - left, 0) + SMOOTH) - np.log(rows) - np.log(np.maximum(into[own][:, None] - n, least))
    after = np.log(np.maximum(joint[own] - right, 0) + SMOOTH) - np.log(into) - np.log(np.maximum(rows[own][:, None] - n, least))
    every = np.arange(len(own))
    mine = (left * before + right * after).sum(axis=1)
    gain[every, own] = mine
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[every, best] > mine + 1e-9, best, own)


def _refined_classes(docs: DataFrame, known: Known, joint: np.ndarray, text_column: str) -> np.ndarray:
    """Classes of the frequent words by rank after a sweep; those of the seeds stay."""
    klass = known.klass

    def take(rank: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
        own = klass[rank.to_numpy(zero_copy_only=False)]
        return pa.RecordBatch.from_arrays([rank, pa.array(chosen(own, sums[:, :CLASSES], sums[:, CLASSES:], joint))], names=["rank", "k"])

    rows = _summed(sums_beside(docs, known, text_column), "rank", take, "rank long, k long").toPandas()  # at most FREQUENT rows
    klass = klass.copy()
    klass[rows["rank"].to_numpy(np.int64)] = rows["k"].to_numpy(np.int64)
    return klass


def _rare_classes(docs: DataFrame, known: Known, joint: np.ndarray, text_column: str) -> DataFrame:
    """``(word, c, k)``: count and class of each rare word."""
    home = known.home

    def take(word: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
        left, right = sums[:, :CLASSES], sums[:, CLASSES:]
        best = chosen(home[_tail_types(word)], left, right, joint)
        return pa.RecordBatch.from_arrays([word, pa.array(left.sum(axis=1).astype(np.int64)), pa.array(best)], names=["word", "c", "k"])

    return _summed(rare_beside(docs, known, text_column), "word", take, "word string, c long, k long")


def likelihood(joint: np.ndarray) -> float:
    """log likelihood of the class bigrams and of the classes' words, but for a constant."""
    return float(_xlogx(joint).sum() - _xlogx(joint.sum(axis=0)).sum() - _xlogx(joint.sum(axis=1)).sum())


@dataclass
class ClassModel:
    """All that a task needs: seed classes, transitions, emission denominators, and the frequent words by rank."""

    home: np.ndarray
    transition: np.ndarray
    size: np.ndarray
    words: pa.Array
    counts: np.ndarray
    klass: np.ndarray
    tokens: int
    vocabulary: int
    ends: int

    @property
    def rank(self) -> dict[str, int]:
        """Rank of each frequent word."""
        return {word: n for n, word in enumerate(self.words.to_pylist())}

    @property
    def base_size(self) -> float:
        return math.log10(self.tokens + ADD * (self.vocabulary + 1))


def learned(docs: DataFrame, text_column: str = "text") -> tuple[ClassModel, DataFrame]:
    """The model of all texts of ``docs``, and ``(word, c, k)`` of the words that it does not hold. Null texts count as empty.

    In the transitions a rare word counts by its ending; its own class is that of its emission and of its place in a score.
    """
    counts = stored(word_counts(docs, text_column), "words")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    words, seen = frequent_words(counts, FREQUENT)
    types = Types({word: 1 + n for n, word in enumerate(words[:TYPES].to_pylist())})
    home = exchange(bigram_counts(docs, types, text_column))
    known = Known(words, home[types.of(words)], home)
    joint = class_bigrams(docs, known, text_column)
    for _ in range(REFINEMENTS if len(words) > TYPES else 0):
        tried = Known(words, _refined_classes(docs, known, joint, text_column), home)
        after = class_bigrams(docs, tried, text_column)
        if likelihood(after) <= likelihood(joint):
            break
        known, joint = tried, after
    rare = stored(_rare_classes(docs, known, joint, text_column), "classes")
    klass = known.klass
    share = (joint.sum(axis=0) + 1e-3) / (joint.sum() + 1e-3 * CLASSES)
    transition = np.log10((joint + BACK_OFF * share) / (joint.sum(axis=1, keepdims=True) + BACK_OFF))
    texts = int(joint[:, 0].sum())
    held, uses = np.bincount(klass, minlength=CLASSES).astype(float), np.bincount(klass, seen, CLASSES)
    for row in rare.groupBy("k").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect():
        held[row.k] += row.n
        uses[row.k] += row.c
    held[0], uses[0] = (1 if texts else 0), texts
    sizes = np.log10(uses + ADD * (held + 1))
    tokens, vocabulary = int(totals.n) + texts, int(totals.v) + (1 if texts else 0)
    return ClassModel(home, transition, sizes, words, seen, klass, tokens, vocabulary, texts), rare


_MET = "singles array<struct<word: string, n: long, uses: array<long>>>, pairs array<struct<a: string, b: string, n: long>>"


def _as_unseen(docs: DataFrame, model: ClassModel, id_column: str, text_column: str) -> DataFrame:
    """Sums of each text as if its rare words were unseen, and these words: ``(row_key, id, n, seen, base, own, singles, pairs)``.

    ``singles`` has each rare word with its uses and the classes beside them that are certain, as in :func:`sums_beside`;
    ``pairs`` has two rare words side by side.
    """
    known = Known(model.words, model.klass, model.home)
    counts, transition, size = model.counts, model.transition, model.size
    unseen, ends, width = math.log10(ADD), int(model.ends > 0), 2 * CLASSES
    end_base = math.log10(model.ends + ADD) - model.base_size
    end_own = math.log10(model.ends + ADD) - float(size[0])
    base_size = model.base_size
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            held = _Slice(part, 2, known)
            lengths, many, vocabulary = held.lengths, len(held.lengths), max(len(held.words), 1)
            rare = held.line < 0
            used = np.where(rare, unseen, 0.0)
            used[~rare] = np.log10(counts[held.line[~rare]] + ADD)
            step = np.concatenate(([0.0], np.cumsum(transition[held.around[:-1], held.around[1:]])))
            stops = np.cumsum(lengths + 1)
            moves = step[stops] - step[stops - lengths - 1]
            sums, sized = np.bincount(held.owner, used, many), np.bincount(held.owner, size[held.kinds], many)
            seen = np.bincount(held.owner[~rare], minlength=many) + ends

            unsure = np.zeros(len(held.around), dtype=bool)
            unsure[held.spot] = rare
            at = np.flatnonzero(rare)
            pair = held.owner[at] * vocabulary + held.codes[at]
            single, place, n = np.unique(pair, return_inverse=True, return_counts=True)
            left, right = held.beside(at)
            sure_left, sure_right = ~unsure[held.spot[at] - 1], ~unsure[held.spot[at] + 1]
            cells, times = np.unique(np.concatenate((place[sure_left] * width + left[sure_left], place[sure_right] * width + CLASSES + right[sure_right])), return_counts=True)
            uses = _lists(cells // width, times * width + cells % width, len(single), pa.int64())
            word = held.words.take(pa.array(single % vocabulary))
            singles = _grouped(single // vocabulary, [word, pa.array(n), uses], ["word", "n", "uses"], many)

            both = at[~sure_right]  # this word and the next are rare
            twos, times = np.unique(np.stack((held.owner[both], held.codes[both], held.codes[both + 1])), axis=1, return_counts=True)
            a, b = (held.words.take(pa.array(twos[k])) for k in (1, 2))
            pairs = _grouped(twos[0], [a, b, pa.array(times)], ["a", "b", "n"], many)

            found = (lengths + 1, seen, sums - lengths * base_size + end_base, moves + sums - sized + end_own)
            columns = [part.column(0), part.column(1), *map(pa.array, found), singles, pairs]
            yield pa.RecordBatch.from_arrays(columns, names=["row_key", "id", "n", "seen", "base", "own", "singles", "pairs"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_key long, id {kind}, n long, seen long, base double, own double, {_MET}")


def _grouped(owner: np.ndarray, columns: list[pa.Array], names: list[str], many: int) -> pa.ListArray:
    """Structs by owner, which ascends, as one list each."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(many + 1)), pa.int32()), pa.StructArray.from_arrays(columns, names=names))


_MORE = "row_key long, seen long, base double, own double"


def _singles_known(held: DataFrame, rare: DataFrame, model: ClassModel) -> DataFrame:
    """What the sums of each text gain as its rare words get their counts and classes, next to certain neighbours."""
    home, transition, size, width = model.home, model.transition, model.size, 2 * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            many = part.num_rows
            n, c, k = (part.column(name).to_numpy(zero_copy_only=False) for name in ("uses_n", "c", "k"))
            e = home[_tail_types(part.column("word"))]
            base = n * (np.log10(c + ADD) - math.log10(ADD))
            lists = part.column("uses")
            uses = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(many), np.asarray(lists.value_lengths()))
            beside, times = uses % width, uses // width
            new, old, other = k[owner], e[owner], beside % CLASSES
            gain = np.where(beside < CLASSES, transition[other, new] - transition[other, old], transition[new, other] - transition[old, other])
            own = base - n * (size[k] - size[e]) + np.bincount(owner, gain * times, many)
            yield pa.RecordBatch.from_arrays([part.column("row_key"), *map(pa.array, (n, base, own))], names=["row_key", "seen", "base", "own"])

    words = held.select("row_key", F.explode("singles").alias("x")).select("row_key", "x.word", F.col("x.n").alias("uses_n"), "x.uses")
    return words.join(rare, "word").mapInArrow(run, _MORE)


def _pairs_known(held: DataFrame, rare: DataFrame, model: ClassModel) -> DataFrame:
    """The same for the transitions between two rare words, of which either may be unseen."""
    home, transition = model.home, model.transition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            old, new = [], []
            for name in "ab":
                old.append(home[_tail_types(part.column(name))])
                found = part.column(f"k{name}")
                new.append(np.where(found.is_valid().to_numpy(zero_copy_only=False), found.fill_null(0).to_numpy(zero_copy_only=False), old[-1]))
            n = part.column("n").to_numpy(zero_copy_only=False)
            own = n * (transition[new[0], new[1]] - transition[old[0], old[1]])
            none = np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(none.astype(np.int64)), pa.array(none), pa.array(own)], names=["row_key", "seen", "base", "own"])

    pairs = held.select("row_key", F.explode("pairs").alias("x")).select("row_key", "x.a", "x.b", "x.n")
    for name in "ab":
        pairs = pairs.join(rare.select(F.col("word").alias(name), F.col("k").alias(f"k{name}")), name, "left")
    return pairs.filter("ka is not null or kb is not null").mapInArrow(run, _MORE)


def score(docs: DataFrame, model: ClassModel, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` of each row of ``docs``.

    Tokens are the words and one end. ``base_score`` is the add-0.1 unigram score, ``score`` the class model's; both are sums
    of log10. Null and empty texts are the end alone; repeated rows and null ids stay rows of their own; an empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    held = stored(_as_unseen(docs, model, id_column, text_column), "unseen")
    more = _singles_known(held, counts, model).unionByName(_pairs_known(held, counts, model))
    sums = more.groupBy("row_key").agg(*[F.sum(c).alias(f"more_{c}") for c in ("seen", "base", "own")])
    rows = held.select("row_key", "id", "n", "seen", "base", "own").join(sums, "row_key", "left")
    plus = lambda c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))
    return rows.select(
        F.col("id").alias(id_column), F.col("n").alias("n_tokens"), plus("seen").alias("n_known"), plus("base").alias("base_score"), plus("own").alias("score")
    )

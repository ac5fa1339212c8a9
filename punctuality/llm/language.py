"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword of bits. For each bit a binary classifier, the log odds of the n-grams of each word,
bounded, averaged over a text's words and put on a logistic scale, says how sure it is that the bit is set. Decoding adds up, over the bits of each codeword, the logistic loss of what the
classifiers say, weighted by how well that bit was told for that language on texts the classifier has not learned from; the
codeword with the least loss wins. Where the second one comes close, the text is flagged as ambiguous.

Learning reads at most ``sample`` texts a language, those of the smallest hashes: three quarters of them give the n-gram counts,
summed by Spark by language and bucket, one quarter the logistic scales and the weights of the bits. What is sent to tasks is
one number a bucket and bit. Prediction is map-only.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import slices, split_words, stored

#: Texts a language that teach.
SAMPLE = 4_000
#: Lengths of n-grams in bytes of UTF-8; a word starts and ends with a space.
ORDERS = (1, 2, 3, 4)
#: Buckets of n-grams, and the share of a bucket that both sides of a bit are taken to have besides what was counted.
BUCKETS, FLOOR = 1 << 16, 1e-6
#: Bits of a codeword beyond ``MOST_EXHAUSTIVE`` languages, for each doubling of their number.
MOST_EXHAUSTIVE, BITS_A_DOUBLING = 6, 10
#: A text is ambiguous if the runner-up has at least this share of the two scores.
CLOSE = 0.25
#: Log odds of a word's n-grams beyond which more of them say little more: a text goes by most of its words, not by the most
#: telling ones.
ENOUGH = 3.0
#: Bytes of words whose n-grams are looked up at once.
BLOCK = 1 << 20
UNKNOWN = "und"


def codewords(languages: int) -> np.ndarray:
    """One row of bits (0, 1) a language, no two alike and no bit equal for all.

    Up to ``MOST_EXHAUSTIVE`` languages every split of them into two sides is a bit; beyond, of some random codes that hang on the
    number of languages alone the one whose two nearest rows lie farthest apart.
    """
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= MOST_EXHAUSTIVE:
        splits = [bits for bits in itertools.product((0, 1), repeat=languages - 1) if any(bits)]
        return np.array([(0, *bits) for bits in splits], np.int8).T
    chance = np.random.default_rng(languages)
    width = BITS_A_DOUBLING * int(np.ceil(np.log2(languages)))
    best, apart = None, 0
    while best is None:
        for _ in range(20):
            code = chance.integers(0, 2, (languages, width), dtype=np.int8)
            signs = 2.0 * code - 1
            near = (width - (signs @ signs.T - 2 * width * np.eye(languages)).max()) / 2
            if near > apart and ((code.min(0) == 0) & (code.max(0) == 1)).all():
                best, apart = code, near
    return best


def _gram_blocks(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(word, order, bucket)`` of the n-grams of each word, by blocks of ``BLOCK`` bytes; each n-gram comes once.

    A word's letters are put in lower case, all else parts it; spaces go before, between and after the rest.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\pL\pM]+", " ")
    plain = pc.utf8_trim(plain, " ")
    real = pc.greater(pc.binary_length(plain), 0)
    number = np.flatnonzero(real.to_numpy(zero_copy_only=False))
    if not number.size:
        return
    padded = pc.binary_join_element_wise(" ", plain.filter(real), " ", "")
    sizes = pc.binary_length(padded).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    _, offsets, data = padded.buffers()
    first = np.frombuffer(offsets, np.int32)[padded.offset]
    held = np.frombuffer(data, np.uint8)[first : first + ends[-1]]
    for at in range(0, len(held), BLOCK):
        places = np.arange(at, min(at + BLOCK, len(held)))
        owner = np.searchsorted(ends, places, side="right")
        room = ends[owner] - places
        mixed = np.zeros(len(places), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            whole = room >= n
            places, owner, room, mixed = places[whole], owner[whole], room[whole], mixed[whole]
            mixed = mixed * np.uint32(0x01000193) + held[places + n - 1] + np.uint32(1)
            if n in ORDERS:
                mask = (mixed ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                yield number[owner], n, (mask >> np.uint32(16)).astype(np.int64) % BUCKETS


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, bucket, n)``: n-grams of ``docs(lang, text)``, counted within each partition before they are summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for part in slices(batches):
            langs = np.array(part.column(0).to_pylist(), object)
            words, uses, counts = split_words(part)
            owner = np.repeat(np.arange(len(counts)), counts)
            blocks = list(_gram_blocks(words))
            for lang in set(langs):
                weight = np.bincount(uses[(langs == lang)[owner]], minlength=len(words))
                total = held.setdefault(lang, np.zeros(BUCKETS))
                for word, _, bucket in blocks:
                    total += np.bincount(bucket, weight[word], BUCKETS)
        for lang, total in held.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Decoder:
    """Languages, their codewords, log odds of each bucket and bit, the logistic scale of each bit, the weight of each
    language and bit. Ready to be sent to tasks."""

    languages: list[str]
    code: np.ndarray
    odds: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def means(self, part: pa.RecordBatch, column: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Mean by bit of what each row's words say, from -1 to 1, and whether the row has a letter at all."""
        words, uses, counts = split_words(part, column)
        sums, real = np.zeros((len(words), self.odds.shape[1])), np.zeros(len(words), bool)
        for word, _, bucket in _gram_blocks(words):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            if len(word):
                sums[word[starts]] += np.add.reduceat(self.odds[bucket], starts, axis=0, dtype=np.float64)
                real[word[starts]] = True
        said = np.tanh(sums / ENOUGH)
        letters = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False).astype(bool)
        total, n, some = np.zeros((len(counts), sums.shape[1])), np.zeros(len(counts)), np.zeros(len(counts), bool)
        filled = np.flatnonzero(counts)
        if filled.size:
            starts = (np.cumsum(counts) - counts)[filled]
            total[filled] = np.add.reduceat(said[uses], starts, axis=0)
            n[filled] = np.add.reduceat(real[uses].astype(np.float64), starts)
            some[filled] = np.logical_or.reduceat(letters[uses], starts)
        return total / np.maximum(n, 1)[:, None], some

    def decode(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score from 0 to 1 and whether the runner-up is close, for each row of :meth:`means`."""
        margin = means * self.scale[:, 0] + self.scale[:, 1]
        signs = 2.0 * self.code - 1
        loss = np.stack([(self.weight[k] * np.logaddexp(0, -signs[k] * margin)).sum(1) for k in range(len(signs))], axis=1)
        share = np.exp(loss.min(1)[:, None] - loss)
        share /= share.sum(1)[:, None]
        best = share.argmax(1)
        top = np.sort(share, axis=1)[:, -2:]
        close = top[:, 0] >= CLOSE * top.sum(1) if share.shape[1] > 1 else np.zeros(len(share), bool)
        return best, share.max(1), close


def _fitted_scale(x: np.ndarray, bit: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, with a small ridge, by Newton's method. The slope never turns the sign."""
    spread = x.std() or 1.0
    inputs, beta = np.stack([x / spread, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        hessian = (inputs * (p * (1 - p))[:, None]).T @ inputs + 0.5 * np.eye(2)
        step = np.linalg.solve(hessian, inputs.T @ (bit - p) - 0.5 * beta)
        beta += step * min(1.0, 2 / np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0] / spread), 1e-6), float(beta[1])


def learned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE) -> Decoder:
    """A decoder from ``docs(id, text, lang)``. Null languages and texts teach nothing; ids only order the sample.

    Rows of one language are thinned by hash to about twice the sample before the smallest hashes are kept, so no group
    grows with the table. Without any language the decoder has none.
    """
    known = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"), F.xxhash64(id_column, text_column).alias("h"))
    known = known.filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("size"))
    few = (F.col("size") <= 2 * sample) | (F.pmod("h", F.lit(1 << 30)) * F.col("size") < 2.0 * sample * (1 << 30))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h", "text"))
    chosen = known.join(F.broadcast(sizes), "lang").filter(few).withColumn("place", place).filter(F.col("place") <= sample)
    chosen = stored(chosen.select("lang", "text", (F.col("place") % 4 == 0).alias("judges")), "languages")
    teaching = chosen.filter("not judges")
    counts = stored(gram_counts(teaching), "grams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    code = codewords(len(languages))
    bits = code.shape[1]
    if not bits:
        return Decoder(languages, code, np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 2)), np.zeros((len(languages), 0)))
    shares = counts.sparkSession.createDataFrame(
        [(lang, float(totals[lang]), [int(b) for b in code[k]]) for k, lang in enumerate(languages)], "lang string, total double, code array<int>"
    )
    sides = np.stack([(code == 0).sum(0), (code == 1).sum(0)])
    part = counts.join(F.broadcast(shares), "lang").withColumn("share", F.col("n") / F.col("total"))
    mean = lambda k, b: F.sum(F.when(F.col("code")[k] == b, F.col("share")).otherwise(0.0)) / float(sides[b, k]) + FLOOR
    rows = part.groupBy("bucket").agg(F.array(*[F.log(mean(k, 1) / mean(k, 0)).cast("float") for k in range(bits)]).alias("odds"))
    odds = np.zeros((BUCKETS, bits), np.float32)
    for r in rows.toLocalIterator():  # one row a bucket: a table of fixed size
        odds[r.bucket] = r.odds
    decoder = Decoder(languages, code, odds, np.tile([1.0, 0.0], (bits, 1)), np.ones((len(languages), bits)))
    return _calibrated(decoder, chosen.filter("judges"))


def _calibrated(decoder: Decoder, judges: DataFrame) -> Decoder:
    """Scales of the bits and weights of language and bit from texts that taught no n-gram, at most a quarter of the sample."""
    number = {lang: k for k, lang in enumerate(decoder.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            means, some = decoder.means(part)
            kept = [(lang, m.tolist()) for lang, m, letter in zip(part.column(0).to_pylist(), means, some, strict=True) if letter and lang in number]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in kept], pa.string()), pa.array([x[1] for x in kept], pa.list_(pa.float64()))], names=["lang", "means"]
            )

    rows = judges.select("lang", "text").mapInArrow(run, "lang string, means array<double>").collect()
    if not rows:
        return decoder
    own = np.array([number[r.lang] for r in rows])
    means = np.array([r.means for r in rows])
    truth = decoder.code[own]
    decoder.scale = np.array([_fitted_scale(means[:, k], truth[:, k].astype(float)) for k in range(truth.shape[1])])
    right = (means * decoder.scale[:, 0] + decoder.scale[:, 1] > 0) == (truth == 1)
    for k in range(len(decoder.languages)):
        told = right[own == k]
        weight = (told.sum(0) + 1.0) / (len(told) + 1.0)
        decoder.weight[k] = weight * len(weight) / weight.sum()
    return decoder


def predict(docs: DataFrame, decoder: Decoder, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, lang_pred, score, ambiguous)`` of each row of ``docs``. Map-only, and of the text alone.

    A null text, one without a letter and any text where no language was learned is ``und`` with score 0. Equal losses go to
    the language that sorts first. Repeated rows and null ids stay rows of their own; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            means, some = decoder.means(part)
            n = part.num_rows
            if decoder.languages:
                best, score, close = decoder.decode(means)
                names = [decoder.languages[k] if letter else UNKNOWN for k, letter in zip(best, some, strict=True)]
                score, close = np.where(some, score, 0.0), close & some
            else:
                names, score, close = [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(close)], names=["id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_column)

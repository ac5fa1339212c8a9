"""Importance resampling towards a target: documents whose word runs are as frequent as in the target are drawn more often.

Features are runs of one to ``longest`` words, joined by one space, and fall into a bucket by their CRC-32. A slice of documents
is scanned once: words, each followed by one space, feed one running CRC, whose value is kept at the end of each word. The
CRC of any run of words then follows from the values before and after it, since the influence of all that came before is the
earlier value shifted by the run's length over GF(2); taking it off leaves the CRC of the run alone, wherever it stands.

Bucket counts of corpus and target are sums over all rows; the gain of a bucket compares them. A document's weight is the mean
gain of its features, its score adds Gumbel noise that hangs on its id alone, and the highest scores are drawn. That is a
draw without replacement in proportion to the exponential of the weights.

Nothing is sorted as a whole. Scores are whole numbers in a narrow range, so their counts are a small table: it gives the number of
rows above each score, and rows of one score are numbered among themselves. Rows that are equal in all that is returned are
one row with a count until the very end.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.common import plain_terms, slices, stored

#: Text of which the words are held at once; a longer text goes on in the next block.
BLOCK_BYTES = 4 << 20
#: Lengths up to which a shift is one table look-up for each byte of a value; longer ones add a look-up for each further bit.
SHORT = 256


@dataclass(frozen=True)
class Resampling:
    """``longest`` words a feature, ``buckets``, the ``seed`` of the noise, the ``percent`` drawn of documents of ``least_words``."""

    longest: int = 2
    buckets: int = 10_000
    seed: int = 7
    percent: int = 25
    least_words: int = 20


def _byte_steps() -> np.ndarray:
    """What one further zero byte makes of each lowest byte of a CRC register (the reflected polynomial of zlib)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


class Shifts:
    """Shifts of CRC values by any number of bytes, as linear maps over GF(2) held by byte of the value."""

    def __init__(self) -> None:
        self.steps = _byte_steps()
        unit = np.arange(256, dtype=np.uint32)
        table = np.stack([unit << np.uint32(8 * k) for k in range(4)])
        short = []
        for _ in range(SHORT + 1):
            short.append(table)
            table = (table >> np.uint32(8)) ^ self.steps[table & np.uint32(255)]
        self.short = np.stack(short[:SHORT])
        self.long = [short[SHORT]]

    @staticmethod
    def _mapped(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = table[0][values & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ table[k][(values >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def __call__(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``values`` as if ``lengths`` zero bytes followed them."""
        rest = lengths % SHORT
        out = self.short[rest, 0, values & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ self.short[rest, k, (values >> np.uint32(8 * k)) & np.uint32(255)]
        above, bit = lengths // SHORT, 0
        while above.size and above.max() > 0:
            if bit == len(self.long):  # twice the shift before: the map applied to itself
                self.long.append(self._mapped(self.long[-1], self.long[-1]))
            odd = np.flatnonzero(above & 1)
            out[odd] = self._mapped(self.long[bit], out[odd])
            above, bit = above >> 1, bit + 1
        return out

    def spaced(self, values: np.ndarray) -> np.ndarray:
        """Running CRCs after one more space."""
        held = ~values
        return ~((held >> np.uint32(8)) ^ self.steps[(held ^ np.uint32(32)) & np.uint32(255)])


def _blocks(data: bytes, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """Parts of about ``limit`` bytes that end in a space, with their places."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= limit else data.rfind(b" ", at, at + limit) + 1
        if end <= at:
            end = data.find(b" ", at) + 1 or len(data)
        yield at, data[at:end]
        at = end


def runs(part: pa.RecordBatch, shifts: Shifts, longest: int, column: int = 1, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """For each block of a slice the row of each word, and for 1 to ``longest`` words the ``(row, CRC)`` of the runs that end there.

    Running CRCs go on from block to block and from text to text; the words before a block that its first runs reach back to
    are kept.
    """
    texts = plain_terms(part, column)
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = data.to_pybytes()[edges[0] : edges[-1]]
    edges = edges - edges[0]
    crc, scan = 0, zlib.crc32
    before = (np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for at, block in _blocks(held, limit):
        words = block.split()
        if not words:
            continue
        ends = []
        first = crc
        for word in words:
            crc = scan(word, crc)
            ends.append(crc)
            crc = scan(b" ", crc)
        after = np.array(ends, np.uint32)
        starts = np.concatenate((np.array([first], np.uint32), shifts.spaced(after[:-1])))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(block, np.uint8) != 32
        places = at + np.flatnonzero(letters & np.concatenate(([True], ~letters[:-1])))
        rows = np.searchsorted(edges, places, side="right") - 1
        new = len(words)
        starts, after, sizes, rows = (np.concatenate(pair) for pair in zip(before, (starts, after, sizes, rows), strict=True))
        found, total, old = [], len(rows), len(rows) - new
        for n in range(1, longest + 1):
            low = max(old - n + 1, 0)
            a, b = np.arange(low, total - n + 1), np.arange(low + n - 1, total)
            same = rows[a] == rows[b]
            a, b = a[same], b[same]
            spread = np.concatenate(([0], np.cumsum(sizes)))
            lengths = spread[b + 1] - spread[a] + n - 1
            found.append((rows[a], after[b] ^ shifts(starts[a], lengths)))
        yield rows[old:], found
        keep = longest - 1
        before = tuple(x[total - keep :] if keep else x[:0] for x in (starts, after, sizes, rows))


def bucket_counts(docs: DataFrame, plan: Resampling = Resampling(), text_column: str = "text") -> DataFrame:
    """``(bucket, n)``: features of all texts by bucket. A partition sends one row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, counts = Shifts(), np.zeros(plan.buckets, np.int64)
        for part in slices(batches, 0):
            for _, found in runs(part, shifts, plan.longest, 0):
                for _, crc in found:
                    counts += np.bincount(crc % np.uint32(plan.buckets), minlength=plan.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["bucket", "n"])

    return docs.select(text_column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), text_column: str = "text") -> np.ndarray:
    """The gain of each bucket, a table of fixed size: thousandths of the log ratio of its shares in target and corpus, one added
    to each count."""
    corpus, wanted = (
        dict(bucket_counts(rows, plan, text_column).toPandas().itertuples(index=False, name=None)) for rows in (docs, target)
    )
    total, aim = sum(corpus.values()) + plan.buckets, sum(wanted.values()) + plan.buckets
    return np.array(
        [math.floor(1000 * math.log(((wanted.get(k, 0) + 1) * total) / ((corpus.get(k, 0) + 1) * aim))) for k in range(plan.buckets)],
        np.int64,
    )


def _noise(identity: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(share))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, plan: Resampling = Resampling(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` of each row of ``docs``. Map-only.

    Null, empty and wordless texts have no features and weight 0. A null id draws its noise as an empty one. Repeated rows
    stay rows; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    names = ("n_words", "n_features", "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for part in slices(batches):
            n = part.num_rows
            words, features, sums = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for rows, found in runs(part, shifts, plan.longest):
                words += np.bincount(rows, minlength=n)
                for own, crc in found:
                    features += np.bincount(own, minlength=n)
                    # whole numbers far below 2^53: exact as doubles
                    sums += np.bincount(own, gain[crc % np.uint32(plan.buckets)], minlength=n).astype(np.int64)
            weight = sums // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (words, features, weight))], names=["id", *names])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, {', '.join(f'{name} long' for name in names)}")
    return found.withColumn("score", F.col("weight") + _noise(F.col("id"), plan.seed)).withColumnRenamed("id", id_column)


def ranked(found: DataFrame, plan: Resampling = Resampling(), id_column: str = "doc_id") -> DataFrame:
    """``(id, n_features, weight, score, rank)``: drawn rows have their rank from 1 on, all others null.

    Of the N rows with ``least_words`` words, floor(percent * N / 100) are drawn, highest scores first, then smaller ids, null
    ids first; rows that are equal in all columns get consecutive ranks. The counts by score are read to the driver: gains and
    noise are thousandths of logarithms of 64-bit counts and 32-bit shares, so there are at most some 120,000 scores.
    """
    rows = stored(found, "weighed")
    enough = F.col("n_words") >= plan.least_words
    counts = sorted(((r.score, r.n) for r in rows.filter(enough).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted = plan.percent * sum(n for _, n in counts) // 100
    above, passed = [], 0
    for score, n in counts:
        if passed >= wanted:
            break
        above.append((score, passed))
        passed += n
    spark, columns = rows.sparkSession, [id_column, "n_features", "weight", "score"]
    lowest = above[-1][0] if above else None
    reached = F.coalesce(enough & (F.col("score") >= F.lit(lowest).cast("long")), F.lit(False))
    ahead = spark.createDataFrame(above, "__score long, ahead long")
    groups = rows.filter(reached).groupBy(*columns).agg(F.count("*").alias("n"))
    groups = groups.join(F.broadcast(ahead), F.col("score") == F.col("__score"))
    order = Window.partitionBy("score").orderBy(F.col(id_column), "n_features", "weight")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    places = groups.withColumn("upto", F.col("ahead") + upto).select(*columns, F.explode(F.sequence(F.col("upto") - F.col("n") + 1, "upto")).alias("rank"))
    places = places.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return places.unionByName(rows.filter(~reached).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, places: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns kept, whose id is drawn. Rows that share an id stay together; null ids go by their own."""
    ids = places.filter(F.col("rank").isNotNull()).select(F.col(id_column).alias("__drawn")).distinct()
    return docs.join(ids, docs[id_column].eqNullSafe(F.col("__drawn")), "left_semi")


def resample(docs: DataFrame, target: DataFrame, plan: Resampling = Resampling(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with its weight, score and, if it is drawn, rank; see :func:`weighed` and :func:`ranked`."""
    gain = gains(docs, target, plan, text_column)
    return ranked(weighed(docs, gain, plan, id_column, text_column), plan, id_column)

"""Best-two-fit packing of token sequences.

A bin is filled greedily with the longest pieces that still fit. Then its smallest piece is taken out if two unpacked
pieces together fill the widened gap more tightly. Only lengths matter, so the unpacked pieces are a count for each
length and a bit set of the lengths that are left; finding "the longest that fits" is one bit operation.

Counts by length are a table of at most ``capacity`` rows, whatever the number of documents, so all pieces are packed as
one: a bin is a pattern of lengths, and the next bins repeat it until one of its lengths runs short. The patterns with their
repeats are a few thousand rows. Pieces are numbered within their length, by groups that are counted first, and a piece's
number tells its sequence and place in it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctuality.llm.bpe import encoder
from punctuality.llm.common import slices, stored, stored_count

CAPACITY = 4096
END = 1


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of each document: its ids and the end id, cut only where they are longer than ``capacity``.

    Columns: id_column, piece, start, length, ids_crc32, row_key, and the ids themselves with ``keep_ids``. ``row_key``
    tells rows with one id apart, so repeated rows and null ids give pieces of their own. A null or empty text is the end
    id alone; an empty table gives no rows. Other columns are not read, whatever their names; the id column itself may not
    have the name of one of these.
    """
    if id_column in ("piece", "start", "length", "ids_crc32", "row_key", "ids"):
        raise ValueError(f"the id column has the name of a result: {id_column}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, tail, width = encoder(path), np.array([end], dtype="<u4").tobytes(), capacity * 4
        for part in slices(batches):
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            found, ends = bpe.encode_slice(part)
            for row, own in enumerate(np.split(found, ends[:-1])):
                packed = own.tobytes() + tail
                for n, at in enumerate(range(0, len(packed), width)):
                    held = packed[at : at + width]
                    rows.append(row)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(held) // 4)
                    crc.append(zlib.crc32(held))
                    if keep_ids:
                        ids.append(np.frombuffer(held, dtype="<i4"))
            at = pa.array(rows, pa.int64())
            columns = [part.column(0).take(at), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc)), part.column(2).take(at)]
            names = [id_column, "piece", "start", "length", "ids_crc32", "row_key"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        bpe.forget()

    rows = docs.select(id_column, text_column, F.monotonically_increasing_id().alias("row_key"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece long, start long, length long, ids_crc32 long, row_key long"
    return rows.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


class _Unpacked:
    """Counts of the pieces left by length, with a bit set of the lengths of which there are any."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.left = sum(1 << size for size, n in counts.items() if n)

    def add(self, size: int, n: int) -> None:
        """``n`` pieces more, or fewer."""
        now = self.counts[size] = self.counts.get(size, 0) + n
        self.left = self.left | 1 << size if now else self.left & ~(1 << size)

    def longest(self, limit: int) -> int:
        """The longest length left that is at most ``limit``; 0 if none."""
        within = self.left & ((1 << (limit + 1)) - 1) if limit > 0 else 0
        return within.bit_length() - 1 if within else 0

    def best_pair(self, gap: int, more_than: int) -> tuple[int, int] | None:
        """The two pieces that together fill the gap most, if they fill more than the given length."""
        best, found = more_than, None
        a = self.longest(gap - 1)
        while a and 2 * a > best:
            b = self.longest(min(a, gap - a))
            if b == a and self.counts[a] < 2:
                b = self.longest(min(a - 1, gap - a))
            if b and a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            a = self.longest(a - 1)
        return found

    def next_bin(self, capacity: int) -> tuple[list[int], Counter]:
        """Take the pieces of a bin: their lengths, and the most of each that were out at any moment."""
        gap, held = capacity, []
        while size := self.longest(gap):
            held.append(size)
            self.add(size, -1)
            gap -= size
        out = Counter(held)
        if gap and self.left:
            pair = self.best_pair(gap + held[-1], held[-1])
            if pair:
                for size in pair:
                    self.add(size, -1)
                out += Counter(pair)
                self.add(held[-1], 1)
                held = [*held[:-1], *pair]
        return held, out


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """The bins of best-two-fit over the given numbers of pieces by length, as lengths and how often they repeat in a row.

    A bin comes out as the one before as long as no length that it takes is about to run out, so such bins are taken at once.
    """
    unpacked, out = _Unpacked(counts), []
    while unpacked.left:
        held, most = unpacked.next_bin(capacity)
        need = Counter(held)
        # Two pieces to spare, so that no choice sees a length end, nor a pair of one length that has become single.
        more = max(0, min((unpacked.counts[size] - most[size] - 2) // n + 1 for size, n in need.items()))
        more = more if all(unpacked.counts[size] >= most[size] + 2 for size in most) else 0
        for size, n in need.items():
            unpacked.add(size, -n * more)
        out.append((held, 1 + more))
    return out


@dataclass
class Places:
    """Where the pieces go by length and number: runs of numbers with their first sequence, pieces a sequence and offsets."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, bins: list[tuple[list[int], int]]) -> Places:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        offsets: dict[int, list[int]] = {}
        used: Counter = Counter()
        number = 0
        for held, times in bins:
            starts = dict.fromkeys(held)
            at = 0
            for size in held:
                starts[size] = [*(starts[size] or []), at]
                at += size
            for size, own in starts.items():
                kept = offsets.setdefault(size, [])
                rows.setdefault(size, []).append((used[size], number, len(own), len(kept)))
                kept += own
                used[size] += len(own) * times
            number += times
        return cls({size: (*(np.array(column, np.int64) for column in zip(*held, strict=True)), np.array(offsets[size], np.int64)) for size, held in rows.items()})

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length):
            own = np.flatnonzero(length == size)
            first, start, each, kept, offsets = self.runs[int(size)]
            run = np.searchsorted(first, number[own], side="right") - 1
            past = number[own] - first[run]
            sequence[own] = start[run] + past // each[run]
            offset[own] = offsets[kept[run] + past % each[run]]
        return sequence, offset


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece. Pieces of equal length are used in the order given."""
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(lengths, kind="stable")
    starts = np.searchsorted(lengths[order], lengths[order])
    number = np.empty(len(lengths), np.int64)
    number[order] = np.arange(len(lengths)) - starts
    return Places.of(patterns(Counter(lengths.tolist()), capacity)).find(lengths, number)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = 8192) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They need ``length`` (1 to capacity), ``piece`` and ``row_key``.

    All pieces are packed as one, however many there are; ``group_pieces`` are numbered together. The pieces are stored first:
    what is numbered must not change if a task runs again. Equal lengths are told apart by a hash, row_key and piece, so the
    result is the same each time. No pieces give no rows.
    """
    kept, n = stored_count(pieces, "pieces")
    groups = max(1, -(-n // group_pieces))
    slim = kept.select("row_key", "piece", "length", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)).alias("pack_group"))
    sizes = stored(slim.groupBy("length", "pack_group").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    places = Places.of(patterns(counts, capacity))
    so_far = Window.partitionBy("length").orderBy("pack_group").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "pack_group", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "pack_group").orderBy("row_key", "piece"))
    numbered = slim.withColumn("inside", inside).join(before, ["length", "pack_group"])
    numbered = numbered.select("row_key", "piece", "length", (F.col("before") + F.col("inside") - 1).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = places.find(*(part.column(name).to_numpy(zero_copy_only=False) for name in ("length", "number")))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, found)], names=["row_key", "piece", "sequence_id", "offset"])

    placed = numbered.mapInArrow(run, "row_key long, piece long, sequence_id long, offset long")
    return kept.join(placed, ["row_key", "piece"])

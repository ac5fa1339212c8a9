"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. **Digests.** A document's shingles (runs of ``shingle`` words) are hashed to 64 bits. Of each of K permuted hashes the
   minimum is taken; groups of ``rows`` minima make the band keys, and the two low bits of every minimum are packed into
   a signature.
2. **Classes.** Documents with one shingle set are one class; only its smallest id goes on.
3. **Candidates.** Classes that share a band key form a bucket. A bucket's members are compared with one head, never all
   with each other; components of the confirmed links are merged; and only members of different components are
   compared again, with another head. What then still lies apart in a bucket is compared with its members of other
   components, so no link between different components is missed; shingles that nobody else has bound the similarity
   from above and rule out most of these pairs.
4. **Estimate.** The packed signatures of a pair are compared by bit counts. With two bits, unequal minima agree by chance in
   a quarter of the places; the corrected estimate rejects a pair only where it lies ``SIGMAS`` deviations below the
   threshold.
5. **Confirmation.** The pairs that are left fetch both texts and compare the whole sets.

Bands are as many as make the chance to miss a pair at the threshold at most ``MISS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import slices, spans_of, split_words, stored, stored_count
from punctuality.llm.components import components

MISS = 1e-8
SIGMAS = 5.5
#: Rounds in which every bucket compares its members with one head, before what is left is compared member by member.
STAR_ROUNDS = 2
#: Minima of the signatures that the sets of these last pairs are given.
FINE = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``shingle`` words; a link at ``percent`` or more: 100 * intersection >= percent * union."""

    shingle: int = 5
    percent: int = 80
    rows: int = 4
    least_hashes: int = 128

    @property
    def threshold(self) -> float:
        return self.percent / 100

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log1p(-(self.threshold**self.rows)))

    @property
    def hashes(self) -> int:
        """Minima in all: those of the bands, rounded up to whole words of 32 two-bit values, ``least_hashes`` at least."""
        return max(self.least_hashes, -(-self.bands * self.rows // 32) * 32)

    @property
    def longs(self) -> int:
        return self.hashes // 32

    @property
    def least_agreement(self) -> int:
        """Equal two-bit values below which a pair is rejected."""
        chance = self.threshold + (1 - self.threshold) / 4
        return math.floor(self.hashes * chance - SIGMAS * math.sqrt(self.hashes * chance * (1 - chance)))

    @cached_property
    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(20240229)
        odd = rng.integers(0, 2**32, self.hashes, dtype=np.uint32) | np.uint32(1)
        return odd, rng.integers(0, 2**32, self.hashes, dtype=np.uint32)


def shingle_sets(part: pa.RecordBatch, size: int, column: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row as 64-bit hashes, rows one after the other, and how many each has.

    A text of fewer words than ``size`` has its whole sequence as one shingle, one without words none.
    """
    words, codes, counts = split_words(part, column, lower=True)
    value = np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64)[codes]
    starts, _ = spans_of(counts)
    windows = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), windows)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + starts[owner]
    width = np.minimum(counts, size)[owner]
    padded = np.concatenate((value, np.zeros(size, np.uint64)))
    hashed = width.astype(np.uint64)
    for step in range(size):
        hashed = np.where(step < width, (hashed ^ padded[at + step]) * _MIX, hashed)
        hashed ^= hashed >> np.uint64(32)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    first = np.ones(len(hashed), dtype=bool)
    first[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[first], np.bincount(owner[first], minlength=len(counts))


def _signature(held: np.ndarray, how: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed two-bit signature of one set."""
    odd, add = how.permutations
    low = (held >> np.uint64(7)).astype(np.uint32)
    minima = np.full(how.hashes, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 4096):  # a block of the set at a time, so memory does not grow with the text
        block = low[start : start + 4096]
        np.minimum(minima, (odd[:, None] * block[None, :] + add[:, None]).min(axis=1), out=minima)
    used = minima[: how.bands * how.rows].astype(np.uint64).reshape(how.bands, how.rows)
    keys = np.arange(1, how.bands + 1, dtype=np.uint64)
    for row in range(how.rows):
        keys = (keys ^ used[:, row]) * _MIX
        keys ^= keys >> np.uint64(29)
    bits = ((minima * np.uint32(0x85EBCA6B)) >> np.uint32(30)).astype(np.uint64).reshape(how.longs, 32)
    packed = (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64)
    return keys.view(np.int64), packed.view(np.int64)


def digests(docs: DataFrame, how: Similarity, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id_column, n_shingles, set1, set2, bands, signature)``; a document without words has null from set1 on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed, sizes = shingle_sets(part, how.shingle)
            starts, ends = spans_of(sizes)
            sets, bands, signatures = [], [], []
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                if a == b:
                    sets.append(None)
                    bands.append(None)
                    signatures.append(None)
                    continue
                keys, packed = _signature(hashed[a:b], how)
                name = xxhash.xxh3_128_digest(hashed[a:b].tobytes())
                sets.append(np.frombuffer(name, dtype=">i8").tolist())
                bands.append(keys)
                signatures.append(packed)
            columns = [
                part.column(0), pa.array(sizes.astype(np.int64)),
                *(pa.array([s and s[i] for s in sets], pa.int64()) for i in (0, 1)),
                pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_shingles", "set1", "set2", "bands", "signature"])

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_shingles long, set1 long, set2 long, bands array<long>, signature array<long>")


def agreement(a: str, b: str, how: Similarity) -> Column:
    """Equal two-bit values of two signatures, by bit counts."""
    low = 0x5555555555555555
    unequal = F.lit(0)
    for i in range(how.longs):
        x = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
        unequal = unequal + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(low)))
    return F.lit(how.hashes) - unequal


def confirmed(pairs: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough. ``docs`` has node and text.

    Texts join the pairs side by side, so a head of many pairs is a hot key of a join that can be split.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), 2):
                mine, sizes = shingle_sets(part, how.shingle, 2)
                heads = part.column(0).to_pylist()
                own_starts, own_ends = spans_of(sizes)
                kept, last, other = [], None, None
                for row in range(part.num_rows):
                    if other is None or heads[row] != last:
                        other, _ = shingle_sets(part.slice(row, 1), how.shingle, 3)
                        last = heads[row]
                    own = mine[own_starts[row] : own_ends[row]]
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    kept.append(both > 0 and 100 * both >= how.percent * (len(own) + len(other) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    with_b = pairs.join(docs.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(docs.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return with_both.select("a", "b", "text_b", "text_a").mapInArrow(run, "a long, b long")


def _label(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("component", F.col("node"))
    return buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def clusters(classes: DataFrame, docs: DataFrame, links: DataFrame, how: Similarity) -> DataFrame:
    """``(node, component)`` of the classes that are linked, by similarity or by the given ``links(a, b)``.

    ``classes`` has node, size, bands and signature, ``docs`` node and text.
    """
    keyed = classes.select("node", "signature", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    buckets = stored(keyed.join(shared, "band"), "buckets")
    docs = stored(docs.join(buckets.select("node").distinct(), "node").select("node", "text"), "texts")
    links, count = stored_count(links, "links")
    labels = stored(components(links), "labels") if count else None
    for turn in range(STAR_ROUNDS + 1):
        members = _label(buckets, labels)
        if turn < STAR_ROUNDS:
            pairs = _stars(members, turn, how)
        else:
            pairs = _apart(stored(members, "members"), classes, docs, how)
        pairs, count = stored_count(pairs, "pairs")
        if not count:
            continue
        found, count = stored_count(confirmed(pairs, docs, how), "links")
        if count:
            links = links.unionByName(found)
            labels = stored(components(links), "labels")
    return labels if labels is not None else classes.select("node", F.col("node").alias("component")).limit(0)


def _stars(members: DataFrame, turn: int, how: Similarity) -> DataFrame:
    """Pairs of each bucket's head and its members of other components that the estimate passes."""
    order = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
    facts = F.min_by(F.struct("node", "component", "signature"), F.struct(order, "node")).alias("head")
    heads = members.groupBy("band").agg(facts, F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    heads = heads.select("band", F.col("head.node").alias("a"), F.col("head.component").alias("ca"), F.col("head.signature").alias("signature_a"))
    apart = (members["component"] != heads["ca"]) & (agreement("signature_a", "signature", how) >= how.least_agreement)
    return members.join(heads, (members["band"] == heads["band"]) & apart).select("a", F.col("node").alias("b")).distinct()


def unshared(docs: DataFrame, how: Similarity) -> DataFrame:
    """``(node, unshared)``: shingles of ``docs(node, text)`` that no other node of ``docs`` has, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed, sizes = shingle_sets(part, how.shingle)
            owner = part.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.RecordBatch.from_arrays([owner, pa.array(hashed.view(np.int64))], names=["node", "shingle"])

    rows = docs.select("node", "text").mapInArrow(run, "node long, shingle long")
    seen = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    return seen.filter("node = last").groupBy("node").agg(F.count("*").alias("unshared"))


def _apart(members: DataFrame, classes: DataFrame, docs: DataFrame, how: Similarity) -> DataFrame:
    """Pairs of one bucket and different components: one of each pair lies outside the bucket's largest component.

    Three tests are part of the join. A set can share at most what others have too, so its unshared shingles bound the
    similarity from above. Then the estimate, and a finer one by ``FINE`` minima, which only the sets that are still here
    are given; in a large group of ever more different copies these leave few pairs. An id of several texts goes by
    the coarse estimate alone. A pair comes from the first band that it shares, so each is made once.
    """
    sizes = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    held = stored(members.join(main.filter("parts > 1"), "band"), "apart")
    nodes = held.select("node").distinct()
    alone = unshared(docs.join(nodes, "node", "left_semi"), how)
    mine = classes.join(nodes, "node", "left_semi")
    texts = docs.join(nodes, "node", "left_semi")
    each = F.xxhash64("text")  # the bound is of one text, and so is the fine signature
    several = texts.groupBy("node").agg(F.min(each).alias("lo"), F.max(each).alias("hi")).filter("lo <> hi").select("node", F.lit(True).alias("several"))
    facts = mine.join(alone, "node", "left").join(several, "node", "left")
    lost = F.when(F.col("several").isNull(), F.coalesce("unshared", F.lit(0))).otherwise(0)
    facts = facts.select("node", "bands", "size", (F.col("size") - lost).alias("common"), "several")
    facts = stored(facts.filter(F.col("common") * 100 >= how.percent * F.col("size")), "facts")
    fine = replace(how, least_hashes=FINE)
    single = texts.join(facts.filter("several is null").select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    signed = digests(single, fine, "node").select("node", F.col("signature").alias("fine"))
    held = stored(held.join(facts.drop("several"), "node").join(signed, "node", "left"), "apart")
    names = ("node", "component", "signature", "bands", "size", "common", "fine")
    a, b = (held.select(F.col("band").alias(f"band_{x}"), "main", *(F.col(c).alias(f"{c}_{x}") for c in names)) for x in "ab")
    a = a.filter("component_a <> main").drop("main")
    apart = (F.col("component_a") != F.col("component_b")) & ((F.col("component_b") == F.col("main")) | (F.col("node_a") < F.col("node_b")))
    most = F.least("common_a", "common_b")
    possible = most * 100 >= how.percent * (F.col("size_a") + F.col("size_b") - most)
    near = agreement("signature_a", "signature_b", how) >= how.least_agreement
    near &= F.coalesce(agreement("fine_a", "fine_b", fine) >= fine.least_agreement, F.lit(True))
    first = F.get(F.filter(F.zip_with("bands_a", "bands_b", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()), F.lit(0))
    met = a.join(b, (F.col("band_a") == F.col("band_b")) & apart & possible & near & (first == F.col("band_a")))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(docs: DataFrame, how: Similarity = Similarity(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:  # noqa: B008
    """``(id_column, n_shingles, component_id, kept)`` of each row of ``docs``; ids are whole numbers.

    ``component_id`` is the smallest id reachable by links, the document itself included, and ``kept`` marks it. Rows
    that share an id are one document of several texts: whatever links with one of them links with the id. Documents
    without words (null, empty, only white space) link with nothing; so do rows with a null id, which are kept with a
    null component. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).alias("text"))
    held = stored(digests(rows, how, "node"), "digests")
    real = held.filter("node is not null and set1 is not null")
    first = real.groupBy("set1", "set2").agg(F.min("node").alias("class"))
    named = real.join(first, ["set1", "set2"])
    head = F.col("node") == F.col("class")
    named = stored(named.select("node", "class", F.col("n_shingles").alias("size"), F.when(head, F.col("bands")).alias("bands"), F.when(head, F.col("signature")).alias("signature")), "classes")
    several = named.groupBy("node").agg(F.min("class").alias("b"), F.max("class").alias("most")).filter("b <> most")
    links = named.join(several, "node").select(F.col("class").alias("a"), "b").filter("a <> b")
    classes = named.filter("bands is not null").dropDuplicates(["node", "bands"]).select("node", "size", "bands", "signature")
    labels = clusters(classes, rows, links, how).withColumnRenamed("node", "class")
    final = named.select("node", "class").join(labels, "class", "left")
    final = final.groupBy("node").agg(F.min(F.coalesce("component", "class")).alias("component"))
    whole = held.select("node", "n_shingles").join(final, "node", "left")
    component = F.coalesce("component", "node")
    return whole.select(F.col("node").alias(id_column), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("node"), F.lit(True)).alias("kept"))

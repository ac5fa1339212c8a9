"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Homoglyphs, full-width letters and digits that stand for letters are folded first, so that disguised words are found
as well. Terms are beginnings of words and are learned from labelled documents: the log odds of their uses, kept where a
likelihood ratio says that neither uses nor texts differ by chance. A term does not count inside an exception, a pair of
words that other texts have and toxic ones hardly. The weights found are summed, and a logistic curve turns the sum and the
sum for each hundred words into a score from 0 to 1.

Learning reads at most ``SAMPLE`` labelled documents, those whose ids have the smallest hashes; scoring is map-only.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import slices, stored

SAMPLE = 20_000
#: A term is a beginning of a word of so many letters, or a whole word that has fewer, written with a space behind it.
LEAST_LETTERS, MOST_LETTERS = 4, 16
#: Lowest log odds of a term's uses, and lowest likelihood ratio of the texts that have it (5.7e-7 by chance).
LEAST_WEIGHT, SURPRISE = 2.5, 25.0
THRESHOLD = 0.3
#: Letters of other scripts that look like Latin ones (fixed values), and digits and signs used for letters.
HOMOGLYPHS = dict(
    zip(
        "абвгдеёзіїјкмнорстухѕԁԛԝһ" + "αβγεηικνορτυχω",
        "abbrdee3iijkmhopctyxsdqwh" + "aByenikvoptuxw".lower(),
        strict=True,
    )
)
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
WIDE = {chr(code): chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}
ALIKE = str.maketrans(HOMOGLYPHS | WIDE)
LETTERS = str.maketrans(DIGITS)
WORD = re.compile(r"[^\s]+")
CORE = re.compile(r"^[^\w@$!|]+|[^\w@$|]+$")


def fold(text: str) -> list[str]:
    """Folded words of a text. Signs at a word's edges are dropped; a word without a letter stays a number."""
    out = []
    for word in text.lower().translate(ALIKE).split():
        core = word if word.isalpha() else CORE.sub("", word)
        if core and not core.isalpha():
            core = core.translate(LETTERS) if any(c.isalpha() for c in core) else core
            core = "".join(c for c in core if c.isalnum())
        if core:
            out.append(core)
    return out


@dataclass
class Lexicon:
    """Weights of terms (beginnings of folded words), exception phrases and the curve. Ready to be sent to tasks."""

    weights: dict[str, float]
    exceptions: list[str]
    curve: tuple[float, ...] = (-4.0, 1.0, 1.0)
    _built: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_built": None}

    def _automaton(self) -> ahocorasick.Automaton:
        if self._built is None:
            built = ahocorasick.Automaton()
            for term in self.weights:
                built.add_word(f" {term}", (term, False))
            for phrase in self.exceptions:
                built.add_word(f" {phrase} ", (phrase, True))
            if len(built):
                built.make_automaton()
            self._built = built
        return self._built

    def hits(self, words: list[str]) -> list[tuple[int, str]]:
        """Start in the joined words and term of each hit outside exceptions; of terms in one word the weightiest."""
        built = self._automaton()
        if not len(built) or not words:
            return []
        found: dict[int, str] = {}
        covered = []
        for end, (term, excepted) in built.iter(f" {' '.join(words)} "):
            if excepted:
                covered.append((end - len(term) - 1, end))
            else:
                start = end - len(term)
                if start not in found or self.weights[found[start]] < self.weights[term]:
                    found[start] = term
        covered.sort()
        starts, reach = [a for a, _ in covered], list(itertools.accumulate((b for _, b in covered), max))
        free = lambda start: not (n := bisect.bisect_right(starts, start)) or reach[n - 1] <= start
        return [(start, term) for start, term in found.items() if free(start)]

    def facts(self, text: str) -> tuple[float, float]:
        """Sum of the weights of the hits, and the words of the text."""
        words = fold(text)
        return float(sum(self.weights[term] for _, term in self.hits(words))), float(len(words))

    def score(self, text: str) -> float:
        return _curve(self.curve, *self.facts(text))


def _inputs(total: float, words: float) -> tuple[float, float]:
    """Sum of the weights, and the sum for each hundred words, both as logarithms."""
    return math.log1p(total), math.log1p(100 * total / max(words, 1.0))


def _curve(curve: tuple[float, ...], total: float, words: float) -> float:
    x, y = _inputs(total, words)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, curve[0] + curve[1] * x + curve[2] * y))))


def _fitted_curve(facts: list[tuple[float, float]], labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's method."""
    x = np.array([(1.0, *_inputs(t, w)) for t, w in facts])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (labels - p) - 0.1 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 2 / np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, beta))


def surprise(t: Column, o: Column, all_t: float, all_o: float) -> Column:
    """Likelihood ratio of a term that is seen t times in toxic and o times in other texts, against no difference."""
    share = all_t / max(all_t + all_o, 1)
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    return 2 * (part(t, (t + o) * share) + part(o, (t + o) * (1 - share)))


def _best_terms(rows: list) -> dict[str, float]:
    """Of terms that begin alike one: an extension that keeps nine tenths of the uses, else the shorter."""
    held = {r.term: r for r in rows}
    longest: dict[str, str] = {}
    for term in sorted(held, key=lambda x: (-len(x), x)):
        for size in range(LEAST_LETTERS, len(term)):
            above = held.get(term[:size])
            if above is not None and held[term].t >= 0.9 * above.t and above.term not in longest:
                longest[above.term] = term
    kept: dict[str, float] = {}
    for r in sorted(held.values(), key=lambda r: (-r.g, r.term)):
        term = longest.get(r.term, r.term)
        kept.setdefault(term, float(held[term].weight))
    final = {}
    for term in sorted(kept, key=lambda x: (len(x), x)):
        if not any(term[:size] in final for size in range(LEAST_LETTERS, len(term))):
            final[term] = kept[term]
    return dict(sorted(final.items(), key=lambda x: (-held[x[0]].g, x[0])))


def learned(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """A lexicon from ``labels(id, label)``: null labels and ids without a document teach nothing.

    Texts that are equal count once. Without any toxic label the lexicon is empty and every score is low.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.filter("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    chosen = stored(known.orderBy(F.xxhash64("id"), "id").limit(sample), "labels")
    held = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "id")
    texts = stored(held.groupBy(F.md5("text").alias("same")).agg(F.first("text").alias("text"), F.max("label").alias("label")), "labelled")
    texts = texts.select("text", "label")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            uses: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                uses[label].update(fold(text or ""))
            both = list(uses[0].keys() | uses[1].keys())
            columns = [pa.array(both, pa.string()), *(pa.array([u[w] for w in both], pa.int64()) for u in (uses[1], uses[0]))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "t", "o"])

    words = texts.mapInArrow(counted, "word string, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    words = stored(words, "words")
    total = words.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("o"), F.lit(0)).alias("o")).first()
    starts = F.transform(F.sequence(F.lit(LEAST_LETTERS), F.least(F.length("word"), F.lit(MOST_LETTERS))), lambda n: F.substring("word", F.lit(1), n))
    terms = F.when(F.length("word") < LEAST_LETTERS, F.array(F.concat("word", F.lit(" ")))).otherwise(starts)
    begun = words.select(F.explode(terms).alias("term"), "t", "o").groupBy("term").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    weight = F.log((F.col("t") + 0.5) / (total.t + 1)) - F.log((F.col("o") + 0.5) / (total.o + 1))
    begun = begun.withColumn("weight", weight).withColumn("g", surprise(F.col("t"), F.col("o"), total.t, total.o))
    begun = begun.filter(f"t >= 3 and weight >= {LEAST_WEIGHT} and g >= {SURPRISE}")
    candidates = _best_terms(begun.collect())  # words of the sample, and of these the telling ones
    lexicon = Lexicon(_supported(texts, Lexicon(candidates, [])), [])
    lexicon.exceptions = _exceptions(texts, lexicon)
    lexicon = Lexicon(lexicon.weights, lexicon.exceptions)

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            found = [lexicon.facts(text or "") for text in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)] + [part.column(1)], names=["s", "w", "label"])

    rows = texts.mapInArrow(facts, "s double, w double, label int").collect()
    if len({r.label for r in rows}) == 2:
        lexicon.curve = _fitted_curve([(r.s, r.w) for r in rows], np.array([float(r.label) for r in rows]))
    return lexicon


def _seen(texts: DataFrame, lexicon: Lexicon, phrases: bool) -> DataFrame:
    """``(term, t, o)``: toxic and other texts in which a term is hit, or in which a hit has a word for neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            terms, labels = [], []
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = fold(text or "")
                hits = lexicon.hits(words)
                own = {term for _, term in hits}
                if phrases and hits:
                    ends = np.cumsum([len(word) + 1 for word in words])
                    spots = np.searchsorted(ends, [start for start, _ in hits], side="right").tolist()
                    own = {" ".join(words[a : a + 2]) for n in spots for a in (n - 1, n) if a >= 0 and a + 1 < len(words)}
                terms += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int64())], names=["term", "label"])

    found = texts.mapInArrow(run, "term string, label long").groupBy("term")
    return found.agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))


def _supported(texts: DataFrame, lexicon: Lexicon) -> dict[str, float]:
    """The terms that also tell texts apart, not only uses."""
    sizes = {r.label: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    seen = _seen(texts, lexicon, False).filter(surprise(F.col("t"), F.col("o"), sizes.get(1, 0), sizes.get(0, 0)) >= SURPRISE)
    kept = {r.term for r in seen.select("term").collect()}
    return {term: weight for term, weight in lexicon.weights.items() if term in kept}


def _exceptions(texts: DataFrame, lexicon: Lexicon) -> list[str]:
    """Pairs of words with a term in them that three other texts or more have and hardly any toxic one."""
    benign = _seen(texts, lexicon, True).filter("o >= 3 and t <= 0.1 * o")
    return sorted(r.term for r in benign.collect())  # pairs of words of the sample


def score(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, score, predicted)`` of each row of ``docs``; predicted is 1 from ``THRESHOLD`` on.

    Null and empty texts score as texts without a term. Repeated rows and null ids stay rows of their own; an empty table
    gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [lexicon.score(text or "") for text in part.column(1).to_pylist()]
            columns = [part.column(0), pa.array(found, pa.float64()), pa.array([int(x >= THRESHOLD) for x in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "score", "predicted"])

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, score double, predicted int")

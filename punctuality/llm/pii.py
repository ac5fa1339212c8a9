"""Personal data by candidate gradient boosting.

Exact patterns with checks give the base spans. High-recall generators propose further, overlapping spans (anything
that looks like an address, a number or a secret); boosted trees score them by format and by context, and a threshold
for each kind, calibrated on held-out candidates, selects what is redacted besides the base spans.

The trees are fitted on the candidates of all texts of the corpus, together with made-up examples of each kind, which count
as much as the corpus where that has more. Labels come from the exact checks and, beyond them, from digits, shapes and the words before a
span: national phone numbers, spread cards and spaced addresses are positives; orders, dates and versions are negatives.
Thresholds are calibrated on a third of the candidates, held out from the trees by their hash: on all of these outside the
base patterns, the only ones that detection asks about. Candidates are counted by bins in Spark and never meet in the driver.
Detection is map-only: the model is a few kilobytes.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.boosting import BoostedTrees, counted, fit_counted, quantile_cuts, thresholds_of
from punctuality.llm.common import slices, stored

KINDS = ("email", "ip", "card", "phone", "secret")
PRECISION = 0.98
#: Candidates that a task hands on together, and more by one text at most.
BATCH = 4096
#: Lowest probability at which a candidate is ever taken.
LEAST = 0.5

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
INTERESTING = re.compile(r"[0-9@]")
NUMBER = re.compile(r"\(?[0-9][0-9 ().\-/]{5,}[0-9]")
ASSIGNED = re.compile(r"[A-Za-z_\-]{2,24}[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_\-.=]{8,})")
DENSE = re.compile(r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{20,}={0,2}")
KEYWORD = re.compile(r"(?i)(api.?key|secret|token|passw|passphrase|auth|bearer|private.?key|credential)\W{0,8}$")
#: Addresses that are written apart, cards in fours with other partings, and national phone numbers.
APART_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20@\x20?|@\x20|\x20?[\[(]at[\])]\x20?)"
    r"[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\x20?\.\x20?)[A-Za-z0-9-]++)+"
)
APART_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20\.\x20|\x20?[\[(](?:\.|dot)[\])]\x20?)[0-9]{1,3}){3}(?![0-9])")
APART_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./-]{1,3}[0-9]{4}){3}(?:[\x20./-]{0,3}[0-9]{1,3})?(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)[\x20./-]{0,2}[0-9]{3,4}[\x20./-]?[0-9]{3,5}|[0-9]{3}[\x20./-][0-9]{3}[\x20./-][0-9]{4}|0[0-9]{2,4}[\x20/-][0-9]{5,8})(?![0-9])")
DATE = re.compile(r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}|[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2})(?![0-9])")
MARKED = re.compile(r"[\[(](?:at|dot|\.)[\])]")
#: Words before a span that speak for a kind, or against all of them.
PHONE_WORDS = re.compile(r"(?i)(?<![a-z])(?:tel|phone|telephone|telefon|mobile|mobil|cell|call|fax|hotline|whatsapp|sms)(?![a-z])")
CARD_WORDS = re.compile(r"(?i)(?<![a-z])(?:card|visa|mastercard|credit|debit|karte|kreditkarte)(?![a-z])")
ADDRESS_WORDS = re.compile(r"(?i)(?<![a-z])(?:mail|email|e-mail|contact|write|ip|host|server|address|adresse)(?![a-z])")
OTHER_WORDS = re.compile(
    r"(?i)(?<![a-z])(?:order|invoice|version|release|build|date|dated|isbn|issn|ref|reference|number|no|nr|id|section|chapter|page|serial|part|item|ticket|bestellung|rechnung|datum)(?![a-z])"
)
ENDINGS = frozenset("com org net edu gov info io de fr es it uk us eu ch at example test".split())
CONTEXT = 32
LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @ and domain; from each @ to the left, so that long words cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_LETTERS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield 0, start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans ``(kind, start, end)`` of the exact patterns that pass their checks, by kind and start, in code points."""
    if not INTERESTING.search(text):
        return []
    found = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def proposals(text: str) -> list[Span]:
    """Overlapping spans of high-recall generators, each once, in order."""
    found: set[Span] = set()
    if INTERESTING.search(text):
        found.update(_emails(text))
        found.update((1, m.start(), m.end()) for m in IP.finditer(text))
        found.update((2, m.start(), m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 12)
        found.update((3, m.start(), m.end()) for m in PHONE.finditer(text))
        found.update((3, m.start(), m.end()) for m in NUMBER.finditer(text))
        found.update((4, m.start(), m.end()) for m in DENSE.finditer(text))
        found.update((2, m.start(), m.end()) for m in APART_CARD.finditer(text))
        found.update((3, m.start(), m.end()) for m in NATIONAL.finditer(text))
    marked = MARKED.search(text)
    if marked or "@" in text:
        found.update((0, m.start(), m.end()) for m in APART_EMAIL.finditer(text))
    if marked or " . " in text:
        found.update((1, m.start(), m.end()) for m in APART_IP.finditer(text))
    if "=" in text or ":" in text:
        found.update((4, *m.span(1)) for m in ASSIGNED.finditer(text))
    return sorted(found)


def _nearest(text: str, start: int) -> tuple[bool, bool, bool, bool]:
    """Which of the phone, card, address and other words is the last before ``start``, near by."""
    before = text[max(0, start - CONTEXT) : start]
    ends = [max((m.end() for m in words.finditer(before)), default=-1) for words in (PHONE_WORDS, CARD_WORDS, ADDRESS_WORDS, OTHER_WORDS)]
    last = max(ends)
    return tuple(last >= 0 and e == last for e in ends)


def _shapes(span: Span, held: str, digits: str) -> tuple[bool, bool, bool, bool]:
    """If the span has the full form of an address written apart (email, ip), a spread card, a national phone number."""
    kind = span[0]
    email = kind == 0 and bool(APART_EMAIL.fullmatch(held)) and re.split("[^A-Za-z0-9-]+", held.rstrip("])"))[-1] in ENDINGS
    ip = kind == 1 and bool(APART_IP.fullmatch(held)) and all(int(p) <= 255 for p in re.findall("[0-9]+", held))
    card = kind == 2 and bool(APART_CARD.fullmatch(held)) and 16 <= len(digits) <= 19 and luhn(digits)
    return email, ip, card, kind == 3 and bool(NATIONAL.fullmatch(held))


def features(text: str, span: Span) -> list[float]:
    """Format of the span and what stands around it."""
    kind, start, end = span
    held = text[start:end]
    before, after = text[max(0, start - 24) : start], text[end : end + 8]
    digits = _digits(held)
    letters = sum(c.isalpha() for c in held)
    counts = Counter(held)
    entropy = -sum(n / len(held) * math.log2(n / len(held)) for n in counts.values())
    parts = held.split(".")
    octets = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts if p.isascii()) and all(parts)
    groups = len(re.findall("[0-9]+", held))
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(held), len(digits), letters, sum(c.isupper() for c in held), entropy, groups,
        sum(c in "0123456789abcdefABCDEF" for c in held) / len(held),
        float(16 <= len(digits) <= 19 and luhn(digits)), float(octets), float(8 <= len(digits) <= 15),
        float(held[0] == "+"), float("(" in held), float("@" in held and "." in held[held.find("@") :]), held.count("."),
        float(bool(KEYWORD.search(before.rstrip("=: \"'")[-24:] or ""))), float(before.rstrip(" \"'")[-1:] in ("=", ":") and bool(before)),
        float(before[-1:] in ("\"", "'")), float(after[:1] in ("\"", "'")), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        *map(float, _nearest(text, start)), *map(float, _shapes(span, held, digits)), float(bool(DATE.match(held))),
    ]


def weak_label(text: str, span: Span, base: set[Span]) -> int:
    """1 for what the exact checks confirm, for dense values that a secret's name is given to, and for what the base
    patterns miss: addresses, cards and phone numbers in other forms, unless the words before name something else."""
    if span in base:
        return 1
    kind, start, end = span
    held = text[start:end]
    if kind < 4:
        digits = _digits(held)
        phone, _, _, other = _nearest(text, start)
        said = kind == 3 and phone and 7 <= len(digits) <= 15
        return int(not other and not DATE.match(held) and (said or any(_shapes(span, held, digits))))
    if kind == 4 and len(held) >= 16:
        named = KEYWORD.search(text[max(0, start - 32) : start].rstrip("=: \"'"))
        return int(bool(named) and any(c.isdigit() for c in held) and any(c.isalpha() for c in held) and len(set(held)) >= 8)
    return 0


def made_up(count: int = 120, seed: int = 7) -> list[str]:
    """Short texts with one example of each kind, sound and unsound, so that every kind can be learned."""
    rng = random.Random(seed)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    h = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    w = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    national = lambda: rng.choice([f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)}.{n(3)}.{n(4)}", f"0{n(3)}/{n(6)}"])
    spread = lambda c: rng.choice([".", "  ", " - ", "/"]).join(c[i : i + 4] for i in range(0, 16, 4))
    end = lambda: rng.choice(sorted(ENDINGS))
    out = []
    for _ in range(count):
        stem = n(15)
        card = next(stem + d for d in "0123456789" if luhn(stem + d))
        wrong = card[:-1] + str((int(card[-1]) + rng.randint(1, 9)) % 10)
        octets = [rng.randint(0, 255) for _ in range(4)]
        out += [
            f"{w()} {w()}{n(2)}@{w()}.{w()} {w()}", f"{w()} {w()}@{w()} {w()}", f"{w()} {'.'.join(map(str, octets))} {w()}",
            f"{w()} {octets[0]}.{rng.randint(256, 999)}.{octets[1]}.{octets[2]} {w()}", f"{w()} {card} {w()}", f"{w()} {wrong} {w()}",
            f"{w()} +{n(1)} ({n(3)}) {n(3)}-{n(4)} {w()}", f"{w()} +{n(2)} {n(2)} {w()}", f"{w()} {n(2)}.{n(2)}.{n(4)} {w()}", f"{w()} {n(rng.randint(7, 12))} {w()}",
            f'{rng.choice(["token", "api_key", "secret", "password"])} = "{h(rng.choice([20, 32, 40]))}" {w()}',
            f"{w()} {rng.choice(['tel', 'call', w()])} {national()} {w()}", f"{w()} ({n(3)}) {n(3)}-{n(4)} {w()}", f"{w()} phone {n(3)} {n(4)} {w()}",
            f"{rng.choice(['order', 'invoice no', 'ref'])} {national()} {w()}", f"version {n(1)} . {n(1)} . {n(1)} . {n(1)} {w()}",
            f"{w()} {n(4)}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {w()}", f"date {n(2)}.{n(2)}.{n(4)} {w()}",
            f"{rng.choice(['card', w()])} {spread(card)} {w()}", f"{w()} {spread(wrong)} {w()}", f"order {spread(card)} {w()}",
            f"{w()} {w()} @ {w()}.{end()} {w()}", f"{w()} {w()} (at) {w()} (dot) {end()} {w()}", f"{w()} {w()}[at]{w()}[dot]{end()} {w()}", f"{w()} {w()} @ {w()} . {w()} {w()}",
            f"{w()} {'[.]'.join(map(str, octets))} {w()}", f"{w()} {' . '.join(map(str, octets))} {w()}", f"{w()} {octets[0]}[.]{rng.randint(256, 999)}[.]{octets[1]}[.]{octets[2]} {w()}",
            f'{rng.choice(["token", "api_key"])}: "{h(rng.choice([300, 2000]))}" {w()}',
            f"{rng.choice(['commit', 'checksum', 'id', 'ref'])}: {h(40)} {w()}", f"{w()} {w()}{w()}{w()}{w()}{w()} {w()}", f"{w()} {w()}-{w()}-{w()}-{w()}-{w()}-{w()} {w()}",
        ]
    return out


def labelled(text: str) -> list[tuple[Span, int, bool, list[float]]]:
    """Span, label, if it overlaps no base span, and features of each candidate."""
    base = set(base_spans(text))
    taken = _Taken(base)
    return [(s, weak_label(text, s, base), not taken.meets(s[1], s[2]), features(text, s)) for s in proposals(text)]


class _Taken:
    """Spans that are given, which may overlap, and spans added later, which overlap none; a look-up takes two bisections."""

    def __init__(self, spans: Iterable[Span]):
        given = sorted((start, end) for _, start, end in spans)
        self.starts = [start for start, _ in given]
        self.reach = list(itertools.accumulate((end for _, end in given), max))
        self.added: list[tuple[int, int]] = []

    def meets(self, start: int, end: int) -> bool:
        before = bisect.bisect_left(self.starts, end)
        if before and self.reach[before - 1] > start:
            return True
        at = bisect.bisect_left(self.added, (end, 0))
        return at > 0 and self.added[at - 1][1] > start

    def add(self, start: int, end: int) -> None:
        bisect.insort(self.added, (start, end))


class Detector:
    """The trees and a threshold for each kind."""

    def __init__(self, trees: BoostedTrees, thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans with those selected: none overlaps a base span or a likelier selected one."""
        base = base_spans(text)
        taken = _Taken(base)
        more = [s for s in proposals(text) if not taken.meets(s[1], s[2])]
        if not more:
            return base, base
        score = self.trees.probability(np.array([features(text, s) for s in more]))
        chosen = []
        for i in np.argsort(-score, kind="stable"):
            kind, start, end = more[i]
            if score[i] >= self.thresholds[kind] and not taken.meets(start, end):
                chosen.append(more[i])
                taken.add(start, end)
        return base, sorted([*base, *chosen])


def candidates(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``(text_id, kind, start, end, label, free, row)`` of every candidate, copies of a text counted once; ``row`` has its features."""

    names = ["text_id", "kind", "start", "end", "label", "free", "row"]
    kinds = pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float64())

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 0):
            found: list[tuple] = []
            for text in part.column(0).to_pylist():
                if text:
                    name = xxhash.xxh3_128_digest(text.encode())
                    found += [(name, *span, label, free, row) for span, label, free, row in labelled(text)]
                if len(found) > BATCH:
                    yield table(found)
                    found = []
            yield table(found)

    layout = "text_id binary, kind long, start long, end long, label long, free boolean, row array<double>"
    return docs.select(text_column).mapInArrow(run, layout).distinct()


def fitted(docs: DataFrame, text_column: str = "text") -> Detector:
    """A detector fitted on the candidates of all of ``docs`` and the made-up examples, a third of them held out for the thresholds."""
    spark = docs.sparkSession
    invented = candidates(spark.createDataFrame([(text,) for text in made_up()], "text string"))
    every = candidates(docs, text_column).withColumn("invented", F.lit(False)).unionByName(invented.withColumn("invented", F.lit(True)))
    every = stored(every, "candidates")
    number = {r.invented: r["count"] for r in every.groupBy("invented").count().collect()}
    weight = max(1, round(number.get(False, 0) / number[True]))
    held_out = F.pmod(F.xxhash64("text_id", "kind", "start", "end"), F.lit(3)) == 0
    every = every.withColumns({"held_out": held_out, "n": F.when(F.col("invented"), weight).otherwise(1).cast("long")})
    cuts = quantile_cuts(every.filter(~F.col("held_out")), len(features("0", (0, 0, 1))))
    bins = stored(counted(every.filter(~F.col("held_out") | F.col("free")), cuts, "held_out", "kind", "label"), "candidate-bins")
    trees = fit_counted(bins.filter(~F.col("held_out")), cuts)
    limits = thresholds_of(bins.filter("held_out"), cuts, trees, "kind", PRECISION, LEAST)
    return Detector(trees, [limits.get(kind, LEAST) for kind in range(len(KINDS))])


def _line(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _redacted(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, detector: Detector, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted)`` of each row of ``docs``.

    The counts and the digest are of the base spans, ``spans`` are all, as ``kind:start:end`` in code points by kind and start.
    Null and empty texts have none and stay empty; repeated rows and null ids stay rows of their own; an empty table
    gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts: list[list[int]] = [[], [], [], []]
            digests, lines, texts = [], [], []
            for text in part.column(1).to_pylist():
                base, every = detector.spans(text or "")
                for kind in range(4):
                    counts[kind].append(sum(s[0] == kind for s in base))
                digests.append(hashlib.sha256(_line(base).encode()).hexdigest())
                lines.append(_line(every))
                texts.append(_redacted(text, every) if every else text)
            columns = [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(lines), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted"])

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    counts = "n_email long, n_ip long, n_card long, n_phone long"
    return rows.mapInArrow(run, f"`{id_column}` {kind}, {counts}, base_sha256 string, spans string, redacted string")


def redact(docs: DataFrame, detector: Detector, text_column: str = "text") -> DataFrame:
    """``docs`` with all its columns, each span in the text replaced by the name of its kind. Map-only."""
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, place):
            texts = []
            for text in part.column(place).to_pylist():
                spans = detector.spans(text)[1] if text else []
                texts.append(_redacted(text, spans) if spans else text)
            columns = part.columns
            columns[place] = pa.array(texts, part.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)

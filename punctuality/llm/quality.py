"""Line-first cleaning with DataFrame functions alone.

Each line is judged on its own: punctuation, navigation and boilerplate rules. Lines that fail and later copies of a
line are removed; a document that loses too much of its text that way is rejected. A few counts over the whole text
reject documents that no line rule can judge. One pass over the table, no shuffle and no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "[#*$%&|<>]+"
NOT_BLANK = "[^ \\t\\n\\x0B\\f\\r]"
PARTED = "[ \\t\\n\\x0B\\f\\r]+"
#: Fixed phrases of pages rather than of prose.
BOILERPLATE = (
    "all rights reserved", "cookie", "javascript", "privacy policy", "terms of service", "terms of use", "click here",
    "sign in", "log in", "subscribe", "lorem ipsum", "powered by", "read more", "share this", "licensed under",
)
#: The same as whole words, with or without a plural s.
PHRASES = "(?<![\\p{L}\\p{N}_])(?:" + "|".join(BOILERPLATE) + ")s?(?![\\p{L}\\p{N}_])"
NAVIGATION = ("»", "›", "→", "|")
SENTENCE_END = "[.!?:;…。！？][\"'”’»)\\]]*\\s*$"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document."""

    max_symbol_share: float = 0.08
    max_shouted_share: float = 0.3
    max_capital_share: float = 0.7
    min_letters_for_capitals: int = 20
    max_navigation_words: int = 3
    max_notice_chars: int = 200
    max_phrase_share: float = 0.2
    max_lost_share: float = 0.5
    min_words: int = 50
    max_repeat_share: float = 0.5


def _length_without(text: Column, pattern: str) -> Column:
    """Code points of ``text`` that no match of ``pattern`` covers."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _line_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, PARTED), lambda w: w != ""))


def line_facts(line: Column) -> Column:
    """What the rules need of a line, counted once: names of a struct."""
    return F.struct(
        line.alias("line"),
        _length_without(line, PARTED).alias("size"),
        (F.length(line) - _length_without(line, SYMBOLS)).alias("symbols"),
        (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!")))).alias("shouts"),
        (F.length(line) - _length_without(line, "\\p{Lu}+")).alias("capitals"),
        F.lower(line).alias("low"),
    )


def line_passes(fact: Column, rules: LineRules) -> Column:
    """True if no rule fails the line. Lines without a word fail. Cheap tests come first and spare the others."""
    line, size, capitals = fact["line"], fact["size"], fact["capitals"]
    letters = _length_without(line, "[^\\p{L}]+")
    shouted = (capitals >= rules.max_capital_share * rules.min_letters_for_capitals) & (
        (letters >= rules.min_letters_for_capitals) & (capitals > rules.max_capital_share * letters)
    )
    navigation = reduce(or_, [F.contains(line, F.lit(sign)) for sign in NAVIGATION])
    # One phrase fails a short notice; a longer line fails only if phrases make up much of its words.
    named = reduce(or_, [F.contains(fact["low"], F.lit(phrase)) for phrase in BOILERPLATE]) & fact["low"].rlike(PHRASES)
    rest = _line_words(F.regexp_replace(fact["low"], PHRASES, " "))
    notice = F.length(line) <= rules.max_notice_chars
    boilerplate = named & (notice | (_line_words(line) - rest > rules.max_phrase_share * _line_words(line)))
    return (
        (size > 0)
        & (fact["symbols"] <= rules.max_symbol_share * size)
        & ((fact["shouts"] == 0) | (fact["shouts"] <= rules.max_shouted_share * _line_words(line)))
        & ~shouted
        & ~(navigation & ~line.rlike(SENTENCE_END) & (_line_words(line) <= rules.max_navigation_words))
        & ~boilerplate
    )


def _repeated_windows(words: Column) -> Column:
    """Numbers of the three-word windows found twice or more in ``words``, ascending.

    Windows are compared as 64-bit hashes, sorted together with their numbers so that equal ones lie side by side.
    """
    spots = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(
        F.transform(spots, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    )


def measured(docs: DataFrame, rules: LineRules = LineRules(), text_column: str = "text", prefix: str = "") -> DataFrame:  # noqa: B008
    """``docs`` and, each under ``prefix``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    cleaned, n_lines, n_kept_lines, lost_share and kept.

    Words are runs of anything but space and U+0009 to U+000D. ``cleaned`` holds the lines that pass, each once, in
    order. A document is kept unless it has fewer than ``min_words`` words, more than ``max_repeat_share`` of them
    stand in three-word windows that occur twice or more, or cleaning takes more than ``max_lost_share`` of its
    characters. Null counts as empty, which is rejected. Rows stay as they are otherwise, repeated ones included, and
    an empty table stays empty. Columns of ``docs`` that have the name of a new one are replaced by it: give a
    ``prefix`` to keep both.
    """
    mine = {name: f"__line_{name}" for name in ("text", "words", "lines", "sorted", "spots", "good")}
    at = {name: F.col(column) for name, column in mine.items()}
    held = docs.withColumn(mine["text"], F.coalesce(F.col(text_column), F.lit("")))
    held = held.withColumns(
        {
            mine["words"]: F.filter(F.split(at["text"], PARTED), lambda w: w != ""),
            mine["lines"]: F.filter(F.split(at["text"], "\n"), lambda x: x.rlike(NOT_BLANK)),
        }
    )
    distinct = F.array_distinct(at["lines"])
    held = held.withColumns(
        {
            f"{prefix}n_words": F.size(at["words"]).cast("long"),
            f"{prefix}word_chars": F.length(F.array_join(at["words"], "")).cast("long"),
            f"{prefix}n_symbols": (F.length(at["text"]) - _length_without(at["text"], SYMBOLS)).cast("long"),
            f"{prefix}n_lines": F.size(at["lines"]).cast("long"),
            f"{prefix}n_dup_lines": (F.size(at["lines"]) - F.size(distinct)).cast("long"),
            mine["sorted"]: _repeated_windows(at["words"]),
            mine["good"]: F.filter(F.transform(distinct, line_facts), lambda x: line_passes(x, rules))["line"],
        }
    )
    after = F.concat(F.slice(at["sorted"], F.lit(2), F.size(at["sorted"])), F.array(F.lit(None)))
    pairs = F.zip_with(at["sorted"], after, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    held = held.withColumn(mine["spots"], F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))))
    start = F.struct(F.lit(-3).alias("before"), F.lit(0).alias("n"))
    covered = F.aggregate(
        at["spots"], start, lambda a, i: F.struct(i.alias("before"), (a["n"] + F.least(F.lit(3), i - a["before"])).alias("n")), lambda a: a["n"]
    )
    held = held.withColumns(
        {
            f"{prefix}n_repeat_words": covered.cast("long"),
            f"{prefix}cleaned": F.array_join(at["good"], "\n"),
            f"{prefix}n_kept_lines": F.size(at["good"]).cast("long"),
        }
    )
    own = lambda name: F.col(f"{prefix}{name}")
    left = _length_without(own("cleaned"), PARTED)
    held = held.withColumns(
        {
            f"{prefix}lost_share": F.when(own("word_chars") > 0, 1 - left / own("word_chars")).otherwise(F.lit(0.0)),
            f"{prefix}base_failed": (own("n_words") < rules.min_words)
            | (own("n_repeat_words") > rules.max_repeat_share * own("n_words")),
        }
    )
    held = held.withColumn(f"{prefix}kept", ~own("base_failed") & (own("lost_share") <= rules.max_lost_share))
    return held.drop(*mine.values())


def clean(docs: DataFrame, rules: LineRules = LineRules(), text_column: str = "text") -> DataFrame:  # noqa: B008
    """The documents that are kept, with their cleaned text; all other columns as they are."""
    found = measured(docs, rules, text_column, "__quality_").withColumn("__quality_row", F.monotonically_increasing_id())
    # The row number keeps the filter above the measures; pushed below, it would hold all of them many times over.
    found = found.filter("__quality_kept and __quality_row >= 0")
    return found.withColumn(text_column, F.col("__quality_cleaned")).select(*[F.col(f"`{c}`") for c in docs.columns])

"""Codes, names and display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Form of a line code, and the display texts of the reasons and of missing values.
LINE_CODE_PATTERN = "(C[0-9]+)"
REASON_TITLES = {
    "cancelled_service": "Service annule",
    "missing_realtime_status": "Statut temps reel manquant",
    "delay": "Retard",
    "normal": "Normal",
}
UNKNOWN = "inconnu"
UNKNOWN_LINE = "ligne inconnue"

# Each of these becomes a space in a stop name.
SPACED_OUT = "-'\\*()"


def line_code(reference: Column, fallback: Column) -> Column:
    """First line code inside ``reference``, or ``fallback`` where there is none."""
    found = F.regexp_extract(reference, LINE_CODE_PATTERN, 1)
    return F.coalesce(F.nullif(found, F.lit("")), fallback)


def stop_key(name: Column, collapse_whitespace: bool = False) -> Column:
    """Spelling of a stop name under which both sources are compared.

    One ``translate`` replaces the punctuation. Runs of spaces are kept by default, and so are accents, tabs and a
    space left at the end by a closing bracket; ``collapse_whitespace`` shortens runs to one space.
    """
    spaced = F.translate(F.lower(F.trim(name)), SPACED_OUT, " " * len(SPACED_OUT))
    return F.regexp_replace(spaced, r"\s+", " ") if collapse_whitespace else spaced


def leading_value(items: Column) -> Column:
    """``value`` of the first element of an array of structs; NULL for a missing or empty array."""
    return F.get(items, F.lit(0)).getField("value")


def _given(text: Column) -> Column:
    """NULL for an empty text."""
    return F.nullif(text, F.lit(""))


def line_title(code: Column, short_name: Column) -> Column:
    """Code of a line, followed by its short name in brackets when that says something else."""
    shown = F.coalesce(_given(code), F.lit(UNKNOWN_LINE))
    extra = F.when(_given(short_name) != shown, F.concat(F.lit(" ("), short_name, F.lit(")")))
    return F.concat(shown, F.coalesce(extra, F.lit("")))


def reason_title(code: Column) -> Column:
    """Display text of a reason; an unlisted code is shown with spaces for underscores."""
    shown = F.coalesce(_given(code), F.lit(UNKNOWN))
    listed = F.create_map(*[F.lit(text) for pair in REASON_TITLES.items() for text in pair])
    return F.coalesce(F.try_element_at(listed, shown), F.translate(shown, "_", " "))

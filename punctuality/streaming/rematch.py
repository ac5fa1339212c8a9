"""Matches after a change of the schedule: what the change does not touch stays as it is.

The spans of two loads are compared. Passages whose expected time lies in a span that differs are matched again, all others
neither have another match nor are looked at: only the dates between the load's date and the next one's are opened,
and within their files, which lie by line, only the lines that have changed. Matched rows and samples of the dates touched
are replaced; the figures get one more part, with the wrong rows taken back and the right ones added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality import schemas
from punctuality.config import MatchConfig
from punctuality.functions import service_date
from punctuality.operators.indicators import corrections
from punctuality.operators.matching import changed_spans, hit_by, judge, match_to_loads
from punctuality.operators.ranking import sample_candidates
from punctuality.sources.schedules import Load, last_load, read_loads
from punctuality.sources.store import DATE, Part, Store
from punctuality.streaming.match import CLUSTERED, SCHEDULE

#: Changed lines that are named to the scan; of more lines, all are read and the join alone tells them apart.
MOST_NAMED_LINES = 1_000


def _holding(loads: list[Load], date: str) -> Load | None:
    """The load that a date goes by."""
    return next((x for x in loads if (x.valid_from or "") <= date and (x.until is None or date < x.until)), None)


def _changed_ranges(old: list[Load], new: list[Load]) -> list[tuple[str, str | None, Load | None, Load | None]]:
    """Ranges of dates (first, first of the next) that do not go by the same load any more, with both loads."""
    borders = sorted({load.valid_from or "" for load in (*old, *new)})
    ranges = [(date, end, _holding(old, date), _holding(new, date)) for date, end in zip(borders, [*borders[1:], None], strict=True)]
    return [(a, b, x, y) for a, b, x, y in ranges if (x and x.name) != (y and y.name)]


def rematch(store: Store, spans: str, config: MatchConfig = MatchConfig()) -> list[str]:
    """Bring what :func:`punctuality.streaming.match_waiting` has matched up to the last load; returns the dates touched.

    The result equals matching everything again. A run that fails counts for nothing and may be repeated; a run without a
    change does nothing. The config must be the one the store was matched under.
    """
    spark, seen = store.spark, store.manifest()
    newest = last_load(spark, spans)
    if newest is None or seen.notes.get(SCHEDULE) in (None, newest):
        return []
    old, new = read_loads(spark, spans, upto=seen.notes[SCHEDULE]), read_loads(spark, spans, upto=newest)
    parts, touched = list(seen.parts), []
    for number, (first, end, before, after) in enumerate(_changed_ranges(old, new)):
        inside = lambda part: part.date is not None and first <= part.date and (end is None or part.date < end)  # noqa: B023,E731
        name = f"rematch-{seen.version + 1:012d}-{number}"
        dates, parts = _rematched(store, name, [p for p in parts if inside(p)], [p for p in parts if not inside(p)], before, after, config)
        touched += dates
    store.commit(seen, parts, seen.notes | {SCHEDULE: newest})
    return sorted(touched)


def _rematched(
    store: Store, name: str, here: list[Part], elsewhere: list[Part], before: Load | None, after: Load | None, config: MatchConfig
) -> tuple[list[str], list[Part]]:
    """One range of dates: the dates touched and all parts there are then."""
    of = lambda dataset, dates=None: [p for p in here if p.dataset == dataset and (dates is None or p.date in dates)]
    known = [load for load in (before, after) if load is not None]
    none = known[0].spans.limit(0).withMetadata("bucket", known[0].spans.schema["bucket"].metadata)
    places = changed_spans(before.spans if before else none, after.spans if after else none)
    changed = store.write("changes", name, places.withColumn(DATE, F.lit(None).cast("string")))
    places = store.read("changes", places.schema, changed).drop(DATE)
    lines = [row.line_code for row in places.select("line_code").distinct().limit(MOST_NAMED_LINES + 1).collect()]

    def of_lines(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("line_code").isin(lines)) if len(lines) <= MOST_NAMED_LINES else rows

    hit = hit_by(of_lines(store.read("passages", schemas.PASSAGES, of("passages"))), places, config)
    again = store.write("rematched", name, hit)
    dates = [part.date for part in again]
    if not dates:
        return [], [*elsewhere, *here]
    day = service_date(F.col("expected_departure_ts"), config.rollover_hour, config.time_zone).cast("string").alias(DATE)
    passages = store.read("rematched", schemas.PASSAGES, again).drop(DATE)
    matched = store.read("matched", schemas.MATCHED, of("matched", dates))
    loads = [(load.valid_from, load.spans) for load in (after,) if load] or [("9999-12-31", none)]
    right = judge(match_to_loads(passages, loads, config), config).select("*", day)
    replaced = store.write("matched", name, hit_by(matched, places, config, missed=True).unionByName(right), *CLUSTERED)
    rows = store.read("matched", schemas.MATCHED, replaced)
    wrong, right = hit_by(of_lines(matched), places, config), hit_by(of_lines(rows), places, config)
    made = replaced + store.write("rollup", name, corrections(wrong, right, DATE)) + store.write("samples", name, sample_candidates(rows, DATE))
    gone = {*of("matched", dates), *of("samples", dates)}
    return dates, [*elsewhere, *[part for part in here if part not in gone], *made]

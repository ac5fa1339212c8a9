"""Loads of a schedule: spans with the service date they hold from, in a store, so that a load appears in one step.

A service date goes by the load with the latest date not after its own; of loads with one date the last one counts. A
reader that has opened the manifest keeps the loads it names, whatever is loaded meanwhile.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctuality.config import MatchConfig
from punctuality.operators.matching import GROUP, departure_spans
from punctuality.sources.store import DATE, Part, Store


@dataclass(frozen=True)
class Load:
    """Spans that hold from a service date on, or from the beginning, until the next load's date."""

    valid_from: str | None
    spans: DataFrame
    until: str | None = None
    name: str | None = None


def _store(spark: SparkSession, path: str) -> tuple[Store, str]:
    root, dataset = path.rstrip("/").rsplit("/", 1)
    return Store(spark, root), dataset


def load_schedule(
    schedule: DataFrame, path: str, valid_from: str | None = None, config: MatchConfig = MatchConfig()
) -> Part:
    """Add a load of the schedule to the spans at ``path``: it is there for the next reader, not for those at work.

    The manifest lies beside ``path`` and names every load, so the spans before it can still be read.
    """
    store, dataset = _store(schedule.sparkSession, path)
    seen = store.manifest()
    name, spans = f"load-{seen.version + 1:012d}", departure_spans(schedule, config)
    # The spans of a line and stop come from one task, which holds no more than a day of each: they need no other spread.
    written = store.write(dataset, name, spans.withColumn(DATE, F.lit(valid_from).cast("string")), *GROUP, spread=False)
    part = written[0] if written else Part(dataset, name, valid_from, 0)
    # The layout has the parameters the spans were made under.
    store.commit(seen, [*seen.parts, part], seen.notes | {f"{dataset} {name}": spans.schema.json()})
    return part


def last_load(spark: SparkSession, path: str) -> str | None:
    """Name of the load that was added last; None where there is no manifest."""
    store, dataset = _store(spark, path)
    return max((part.name for part in store.manifest().of(dataset)), default=None)


def read_loads(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, upto: str | None = None) -> list[Load]:
    """The loads that service dates from ``first`` to ``last`` go by, in the order of their dates.

    ``upto`` names a load: later ones are left out. A path without manifest is one dataset of spans for all dates.
    """
    store, dataset = _store(spark, path)
    manifest, newest = store.manifest(), {}
    for part in manifest.of(dataset):  # in the order they were loaded
        if upto is None or part.name <= upto:
            newest[part.date] = part
    if not newest:
        return [Load(None, spark.read.parquet(path))]
    def opened(part: Part) -> DataFrame:
        layout = StructType.fromJson(json.loads(manifest.notes[f"{dataset} {part.name}"]))
        return store.read(dataset, layout, [part]).drop(DATE)

    dates = sorted(newest, key=lambda date: date or "")
    loads = [Load(date, opened(newest[date]), until, newest[date].name) for date, until in zip(dates, [*dates[1:], None], strict=True)]
    needed = [
        load
        for load in loads
        if (load.until is None or first is None or load.until > first)
        and (load.valid_from is None or last is None or load.valid_from <= last)
    ]
    return needed or loads[:1]  # none holds that early: whatever is matched to the first finds nothing

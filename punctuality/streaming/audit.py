"""The audit of collected files, brought up to date by day.

Reports and files arrive in any order. Both are kept by the day in the name of the snapshot file, so a report and its
file always lie in one day, and only the days in which either side has grown are joined again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctuality import schemas
from punctuality.operators.audit import FILE_NAME_PATTERN, audit_snapshots, audit_with_reports
from punctuality.sources.snapshots import follow_reports
from punctuality.sources.store import DATE, Store

#: Notes of the store: the last batch of reports taken, and by day how many documents and entries are audited.
REPORTS_TAKEN, AUDITED = "reports_taken", "audited"


def name_day(name: Column) -> Column:
    """The day in the name of a snapshot file, as text."""
    return F.try_to_date(F.substring(F.regexp_extract(name, FILE_NAME_PATTERN, 2), 1, 8), "yyyyMMdd").cast("string")


def collect_reports(spark: SparkSession, folder: str, output: str, checkpoint: str, files_per_batch: int | None = 10_000) -> StreamingQuery:
    """Start a query that takes the entries of all report files not seen yet into ``reports`` and then stops.

    An entry about a file goes by the day of that file, one about a failed collection by its own time.
    """

    def take(entries: DataFrame, batch: int) -> None:
        store = Store(entries.sparkSession, output)
        seen = store.manifest()
        if batch > int(seen.notes.get(REPORTS_TAKEN, -1)):
            own = F.to_date(F.try_to_timestamp("collected_at")).cast("string")
            day = F.when(F.col("snapshot_file").isNotNull(), name_day(F.col("snapshot_file"))).otherwise(own)
            parts = store.write("reports", f"reports-{batch:09d}", entries.withColumn(DATE, day))
            store.commit(seen, [*seen.parts, *parts], seen.notes | {REPORTS_TAKEN: str(batch)})

    arrivals = follow_reports(spark, folder, files_per_batch)
    return arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def audit_days(store: Store) -> list[str | None]:
    """Audit the days whose documents or report entries have become more since they were audited; returns these days.

    Rows only ever come in addition, so their number tells whether a day has changed; a merge of its parts does not.
    """
    seen = store.manifest()
    sizes: dict[str | None, list[int]] = {}
    for side, dataset in enumerate(("documents", "reports")):
        for part in seen.of(dataset):
            sizes.setdefault(part.date, [0, 0])[side] += part.rows
    done = json.loads(seen.notes.get(AUDITED, "{}"))
    days = {day for day, size in sizes.items() if done.get(str(day)) != size}
    if not days:
        return []
    of = lambda dataset: [part for part in seen.of(dataset) if part.date in days]
    documents = store.read("documents", schemas.DOCUMENTS, of("documents"))
    entries = store.read("reports", schemas.COLLECTION_REPORT, of("reports"))
    found = audit_with_reports(audit_snapshots(documents), entries.drop(DATE))
    day = F.when(F.col("source_file").isNotNull(), name_day(F.col("source_file"))).otherwise(F.to_date("reported_at").cast("string"))
    new = store.write("audit", f"audit-{seen.version + 1:012d}", found.withColumn(DATE, day))
    layout = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in found.schema)
    gone = set(of("audit"))
    notes = {AUDITED: json.dumps(done | {str(day): sizes[day] for day in days}), "audit_layout": layout}
    store.commit(seen, [part for part in seen.parts if part not in gone] + new, seen.notes | notes)
    return sorted(days, key=lambda day: (day is not None, day))


def read_audit(spark: SparkSession, output: str) -> DataFrame:
    """The audit of all days so far; before the first one it has the day alone."""
    store = Store(spark, output)
    manifest = store.manifest()
    return store.read("audit", manifest.notes.get("audit_layout", f"{DATE} string"), manifest.of("audit"))

"""Snapshot files to matched rows, each file opened once.

A batch of arriving files is parsed and kept as one part of the ``documents`` dataset, a few large files whatever the
number of small ones: the parsed document, or the text where it is damaged. That dataset is the ledger of the files
taken, the quarantine of those that could not be read, and what all later work reads. Matching takes all the parts that
are not matched yet at once, since each match reads all spans of its dates however few the passages are, and leaves
``passages``, ``matched`` rows, their ``rollup`` and ``samples`` by service date. All of it belongs to one
:class:`~punctuality.sources.store.Store`, so a batch counts whole or not at all, and a batch that runs again after a
failure leaves no second copy.

A file is never split between batches and an observation never spans files, so the result equals one batch run over
all files and no state is kept. Figures of a rollup are sums and samples are a bounded top-k by date, so a new batch
costs only its own rows, and :func:`compact` keeps the number of files by date bounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punctuality import schemas
from punctuality.config import MatchConfig
from punctuality.functions import service_date
from punctuality.operators.documents import DAMAGED, examine, is_damaged
from punctuality.operators.indicators import ROLLUP_KEY, added, rollup
from punctuality.operators.matching import judge, match_to_loads
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.operators.ranking import sample_candidates
from punctuality.sources.schedules import last_load, read_loads
from punctuality.sources.snapshots import follow_texts, read_texts
from punctuality.sources.store import DATE, Store
from punctuality.streaming.audit import name_day

#: Files in one micro-batch; a backlog is worked off in batches of this size.
FILES_PER_BATCH = 10_000
#: Parts that a date may have before :func:`compact` makes them one.
MOST_PARTS = 8
#: Notes of the store: the last batch of files taken, and the document parts that wait to be matched.
TAKEN, WAITING = "taken", "waiting"
#: Note of the store: the load of the schedule up to which every match is right.
SCHEDULE = "schedule"
#: Passages and matches of one line lie together within a file, so that readers of some lines skip the rest.
CLUSTERED = ("line_code", "stop_point_name")


def _documents(texts: DataFrame) -> DataFrame:
    """Examined documents by the day in their name. The text is kept only where the parsed form does not hold it all."""
    kept = F.when(is_damaged(F.col("status")) | (F.col("status") == "partial"), F.col("document"))
    return examine(texts).withColumn("document", kept).select(*schemas.DOCUMENTS.fieldNames(), name_day(F.col("source_file")).alias(DATE))


def _waiting(notes: dict[str, str]) -> list[str]:
    return [name for name in notes.get(WAITING, "").split(",") if name]


def collect_arrivals(
    spark: SparkSession,
    snapshots: str,
    output: str,
    checkpoint: str,
    files_per_batch: int | None = FILES_PER_BATCH,
    then: Callable[[Store], None] | None = None,
) -> StreamingQuery:
    """Start a query that takes all snapshot files not seen yet into ``documents`` and then stops.

    ``then`` is called after each batch. A batch whose number the store has noted is not taken again.
    """

    def take(texts: DataFrame, batch: int) -> None:
        store = Store(texts.sparkSession, output)
        seen = store.manifest()
        if batch > int(seen.notes.get(TAKEN, -1)):
            name = f"batch-{batch:09d}"
            parts = store.write("documents", name, _documents(texts))
            store.commit(seen, [*seen.parts, *parts], seen.notes | {TAKEN: str(batch), WAITING: ",".join([*_waiting(seen.notes), name])})
        if then is not None:
            then(store)

    arrivals = follow_texts(spark, snapshots, files_per_batch)
    return arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def match_waiting(store: Store, spans: str, config: MatchConfig = MatchConfig()) -> list[str]:
    """Match the document parts that wait for it, all in one pass over the spans; returns their names.

    ``spans`` is a dataset of :func:`punctuality.operators.matching.departure_spans`, or the loads of
    :func:`punctuality.sources.schedules.load_schedule`. It is opened anew by every call, so a new load counts from the next
    call on; only the loads that the service dates of these parts go by are read.
    """

    def day(ts: str) -> Column:
        return service_date(F.col(ts), config.rollover_hour, config.time_zone).cast("string").alias(DATE)

    seen = store.manifest()
    done = _waiting(seen.notes)
    if not done:
        return []
    own = [part for part in seen.of("documents") if part.name in done]
    documents, name = store.read("documents", schemas.DOCUMENTS, own), done[-1]
    arrived = build_passages(flatten_snapshots(documents)).select("*", day("expected_departure_ts"))
    parts = store.write("passages", name, arrived, *CLUSTERED)
    passages = store.read("passages", schemas.PASSAGES, parts)
    dates, newest = [part.date for part in parts if part.date], last_load(store.spark, spans)
    loads = read_loads(store.spark, spans, min(dates, default=None), max(dates, default=None), newest)
    matched = judge(match_to_loads(passages.drop(DATE), [(load.valid_from, load.spans) for load in loads], config), config)
    new = store.write("matched", name, matched.select("*", day("expected_departure_ts")), *CLUSTERED)
    parts += new + _summaries(store, name, store.read("matched", schemas.MATCHED, new))
    notes = {SCHEDULE: newest} if newest and SCHEDULE not in seen.notes else {}
    store.commit(seen, [*seen.parts, *parts], seen.notes | notes | {WAITING: ""})
    return done


def _summaries(store: Store, name: str, matched: DataFrame) -> list:
    """Parts of the figures and samples of matched rows by date, two small jobs side by side."""
    with ThreadPoolExecutor(2) as both:
        made = [
            both.submit(store.write, "rollup", name, rollup(matched, DATE)),
            both.submit(store.write, "samples", name, sample_candidates(matched, DATE)),
        ]
    return [part for parts in made for part in parts.result()]


class Arrivals:
    """A query that takes arriving files, and the work that follows when it has ended; otherwise like the query.

    The work starts by itself when the query has ended without an error, and counts as a part of the query.
    """

    def __init__(self, query: StreamingQuery, afterwards: Callable[[], object]):
        def run() -> None:
            query.awaitTermination()
            afterwards()

        thread = ThreadPoolExecutor(1)
        self._query, self._work = query, thread.submit(run)
        thread.shutdown(wait=False)

    def __getattr__(self, name: str):
        return getattr(self._query, name)

    @property
    def isActive(self) -> bool:  # noqa: N802
        return not self._work.done()

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802
        """Wait for the query and the work; what stopped either of them is raised. With ``timeout``: whether both have ended."""
        if timeout is not None and not wait([self._work], timeout).done:
            return False
        self._work.result()
        return None if timeout is None else True


def match_arrivals(
    spark: SparkSession,
    snapshots: str,
    spans: str,
    output: str,
    checkpoint: str,
    config: MatchConfig = MatchConfig(),
    files_per_batch: int | None = FILES_PER_BATCH,
) -> Arrivals:
    """Start a query that takes all snapshot files not seen yet in batches, matches them and then stops.

    The match comes when the last batch is taken, see :func:`match_waiting`: one for a backlog, however many batches it has. What
    a run that fails leaves unmatched waits for the next one.
    """
    taking = collect_arrivals(spark, snapshots, output, checkpoint, files_per_batch)
    return Arrivals(taking, lambda: match_waiting(Store(spark, output), spans, config))


def replay_mended(spark: SparkSession, folder: str, output: str) -> int:
    """Take the files of ``folder`` that stand for damaged ones of the same name and can be read now; returns how many.

    They wait for :func:`match_waiting` as any other part. Files that are damaged still, that were never damaged or whose
    mended form is taken already are left alone, so the same folder may be given again.
    """
    store = Store(spark, output)
    seen = store.manifest()
    open_names = read_quarantine(spark, output).select("source_file")
    mended = _documents(read_texts(spark, folder)).filter(~is_damaged(F.col("status"))).join(open_names, "source_file", "left_semi")
    name = f"replay-{uuid.uuid4().hex}"
    parts = store.write("documents", name, mended)
    if parts:
        store.commit(seen, [*seen.parts, *parts], seen.notes | {WAITING: ",".join([*_waiting(seen.notes), name])})
    return sum(part.rows for part in parts)


def compact(store: Store, most: int = MOST_PARTS) -> dict[str, list[str | None]]:
    """Make one part of each date that has more than ``most``; returns the dates by dataset.

    Figures are added up and samples cut to the top again, so a date's part of these does not grow with its batches;
    passages and matches become fewer and larger files.
    """
    as_they_are = lambda rows: rows
    ways = {
        "passages": (schemas.PASSAGES, as_they_are, CLUSTERED),
        "matched": (schemas.MATCHED, as_they_are, CLUSTERED),
        "rollup": (schemas.ROLLUP, lambda rows: added(rows, *ROLLUP_KEY, DATE), ()),
        "samples": (schemas.SAMPLES, lambda rows: sample_candidates(rows, DATE), ()),
    }
    done = {name: store.merge(name, layout, merged, most, *sort) for name, (layout, merged, sort) in ways.items()}
    if not _waiting(store.manifest().notes):  # parts of documents are told apart until they are matched
        done["documents"] = store.merge("documents", schemas.DOCUMENTS, as_they_are, most)
    return done


def read_documents(spark: SparkSession, output: str) -> DataFrame:
    """Every snapshot file taken so far, with its status: the ledger. Columns not asked for are not read."""
    return Store(spark, output).read("documents", schemas.DOCUMENTS)


def read_quarantine(spark: SparkSession, output: str) -> DataFrame:
    """Damaged files with their text, without those that a mended one has taken the place of."""
    taken = read_documents(spark, output).withColumnRenamed(DATE, "collected_on")
    mended = taken.filter(~is_damaged(F.col("status"))).select("source_file")
    damaged = taken.filter(F.col("status").isin(*DAMAGED)).join(mended, "source_file", "left_anti")
    return damaged.select("source_file", "status", "bytes", "modified_at", "collected_on", "document")


def read_passages(spark: SparkSession, output: str) -> DataFrame:
    """All passages that were stored so far."""
    return Store(spark, output).read("passages", schemas.PASSAGES)


def read_matches(spark: SparkSession, output: str) -> DataFrame:
    """All matched rows that were stored so far."""
    return Store(spark, output).read("matched", schemas.MATCHED)


def read_rollups(spark: SparkSession, output: str) -> DataFrame:
    """The figures of all batches by date, which the indicators sum up."""
    return Store(spark, output).read("rollup", schemas.ROLLUP)


def read_samples(spark: SparkSession, output: str) -> DataFrame:
    """The candidates of all batches by date, which :func:`punctuality.operators.ranking.worst_samples` takes."""
    return Store(spark, output).read("samples", schemas.SAMPLES)

"""The registered queries: library functions over the test tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality import schemas
from punctuality.config import MatchConfig
from punctuality.functions import instant, line_code, service_date, service_day_seconds, stop_key
from punctuality.operators import audit, indicators, matching, ranking
from punctuality.operators.passages import build_passages, flatten_snapshots
from punctuality.operators.schedule import build_schedule
from punctuality.plans import adapters
from punctuality.plans.files import write_files
from punctuality.sources import catalog, clustered, schedules, sinks, snapshots, tables
from punctuality.sources.publication import Publication
from punctuality.sources.scratch import new_folder
from punctuality.sources.store import DATE, Store
from punctuality.streaming import (
    audit_days,
    collect_arrivals,
    collect_reports,
    compact,
    match_arrivals,
    match_waiting,
    read_audit,
    read_documents,
    read_matches,
    read_passages,
    read_quarantine,
    read_rollups,
    read_samples,
    rematch,
    replay_mended,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NARROW = MatchConfig(tolerance_seconds=900, bucket_seconds=300)
INSTANTS = ("recorded_at_ts", "expected_departure_ts")
MATCH_COLUMNS = (
    *matching.PASSAGE_KEY,
    "is_cancelled",
    "is_unreported",
    "trip_id",
    "departure_time",
    "route_short_name",
    "expected_seconds",
    "planned_seconds",
)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_schedule(**adapters.feed(spark, sf_dir))


def _departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule for a match, which keeps one of equal departures anyway."""
    return build_schedule(**adapters.feed(spark, sf_dir), distinct=False)


def _stored_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`_departures` as a dataset, for several loads of one schedule: its joins are made once."""
    planned, path = _departures(spark, sf_dir), f"{new_folder(spark, 'departures')}/schedule"
    sinks.write_parquet(planned, path)
    return spark.read.schema(planned.schema).parquet(path)


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.judge(matching.match_passages(adapters.passages(spark, sf_dir), _departures(spark, sf_dir)))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.rollup(_matched(spark, sf_dir))


def _instants_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in INSTANTS})


# Sources and scalar functions


@query
def schedule_build(spark, sf_dir):
    return _schedule(spark, sf_dir)


@query
def schedule_from_csv(spark, sf_dir):
    folder = new_folder(spark, "feed")
    for name, rows in adapters.feed(spark, sf_dir).items():
        # Reversed column order and a column nobody asked for: feeds are read by column name.
        shuffled = rows.select(F.lit("x").alias("unused"), *reversed(rows.columns))
        sinks.write_csv(shuffled, f"{folder}/{name}.txt")
    return build_schedule(**tables.read_feed(spark, folder))


@query
def schedule_seconds(spark, sf_dir):
    planned = matching.planned_departures(_schedule(spark, sf_dir))
    return planned.select("line_code", "stop_key", "trip_id", "departure_time", "planned_seconds")


@query
def observations_flatten(spark, sf_dir):
    documents = snapshots.read_snapshots(spark, adapters.snapshot_folder(spark, sf_dir))
    return build_passages(flatten_snapshots(documents)).drop(*INSTANTS)


@query
def observations_parse_time(spark, sf_dir):
    seconds = lambda c: service_day_seconds(instant(F.col(c)), 4)
    return adapters.visits(spark, sf_dir).select(
        "source_file",
        "recorded_at_time",
        seconds("recorded_at_time").alias("recorded_seconds"),
        "expected_departure_time",
        seconds("expected_departure_time").alias("expected_seconds"),
    )


@query
def line_code_extract(spark, sf_dir):
    feed = adapters.feed(spark, sf_dir)
    trips = feed["trips"].join(feed["routes"], "route_id", "left")
    planned = trips.select(F.col("route_id").alias("reference"), F.col("route_short_name").alias("fallback"))
    observed = adapters.visits(spark, sf_dir).select(
        F.col("line_ref").alias("reference"), F.col("line_ref").alias("fallback")
    )
    return (
        planned.unionByName(observed)
        .withColumn("line_code", line_code(F.col("reference"), F.col("fallback")))
        .groupBy("reference", "fallback", "line_code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def stop_name_normalize(spark, sf_dir):
    name = F.concat_ws("", F.lit(" "), "p_name", F.lit(" - l'Arrêt\\("), "p_type", F.lit(")* "))
    return adapters.table(spark, sf_dir, "part").select(
        "p_partkey", stop_key(name).alias("stop_key"), stop_key(name, True).alias("stop_key_collapsed")
    )


# The match


@query
def candidate_pairs(spark, sf_dir):
    found = matching.candidate_statistics(adapters.passages(spark, sf_dir), _schedule(spark, sf_dir))
    # As text: sums over pairs outgrow 64 bits.
    return found.select("line_code", *[F.col(c).cast("decimal(38,0)").cast("string").alias(c) for c in found.columns[1:]])


@query
def nearest_match(spark, sf_dir):
    found = matching.match_passages(adapters.passages(spark, sf_dir), _departures(spark, sf_dir))
    return found.select(*MATCH_COLUMNS)


@query
def nearest_match_window(spark, sf_dir):
    found = matching.match_passages_windowed(adapters.passages(spark, sf_dir), _departures(spark, sf_dir))
    return found.select(*MATCH_COLUMNS)


@query
def nearest_match_bucketed(spark, sf_dir):
    found = matching.match_passages(adapters.passages(spark, sf_dir), _departures(spark, sf_dir), NARROW)
    return found.select(*MATCH_COLUMNS)


@query
def nearest_match_stored(spark, sf_dir):
    """The match from two bucketed tables, which joins them without an exchange."""
    database = f"punctuality_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, new_folder(spark, "warehouse"))
    clustered.save_spans(matching.departure_spans(_departures(spark, sf_dir)), f"{database}.spans", 8)
    clustered.save_observed(adapters.passages(spark, sf_dir), f"{database}.observed", 8)
    return clustered.match_saved(spark, f"{database}.observed", f"{database}.spans").select(*MATCH_COLUMNS)


@query
def matched_classified(spark, sf_dir):
    return _instants_as_text(_matched(spark, sf_dir))


# Indicators


@query
def line_performance(spark, sf_dir):
    return indicators.line_performance(_rollup(spark, sf_dir))


@query
def stop_performance(spark, sf_dir):
    return indicators.stop_performance(_rollup(spark, sf_dir))


@query
def disruption_reasons(spark, sf_dir):
    return indicators.disruption_reasons(_rollup(spark, sf_dir))


@query
def network_overview(spark, sf_dir):
    return indicators.network_overview(_rollup(spark, sf_dir))


@query
def network_kpis(spark, sf_dir):
    return indicators.network_kpis(_rollup(spark, sf_dir))


@query
def reason_share(spark, sf_dir):
    return ranking.top_reasons(_rollup(spark, sf_dir))


# Rankings


@query
def top_lines(spark, sf_dir):
    return ranking.top_lines(line_performance(spark, sf_dir))


@query
def top_stops(spark, sf_dir):
    return ranking.top_stops(stop_performance(spark, sf_dir))


@query
def top_lines_fallback(spark, sf_dir):
    """No line is disrupted among undisrupted observations, so the busiest ones are listed."""
    undisrupted = _matched(spark, sf_dir).filter(~F.col("is_disrupted"))
    return ranking.top_lines(indicators.line_performance(indicators.rollup(undisrupted)))


@query
def chart_series(spark, sf_dir):
    """All three rankings from one stored rollup, as the pipeline has it."""
    path = new_folder(spark, "rollup")
    sinks.write_parquet(_rollup(spark, sf_dir), path)
    figures = tables.read_parquet(spark, path)
    return ranking.chart_series(
        ranking.top_lines(indicators.line_performance(figures)),
        ranking.top_stops(indicators.stop_performance(figures)),
        ranking.top_reasons(figures),
    )


@query
def worst_samples(spark, sf_dir):
    return ranking.worst_samples(_matched(spark, sf_dir))


# Sinks and catalog


def _hundredths(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


@query
def parquet_publish(spark, sf_dir):
    """Matched rows partitioned by service day, written and read back; counts and sums per day, and the writer's count."""
    day = service_date(F.col("expected_departure_ts"), MatchConfig().rollover_hour).cast("string")
    path = new_folder(spark, "matched")
    written = sinks.write_parquet(_matched(spark, sf_dir).withColumn("service_date", day), path, ["service_date"])
    back = spark.read.schema(f"{schemas.MATCHED}, service_date string").parquet(path)
    return (
        back.groupBy("service_date")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(_hundredths("delay_minutes")).alias("delay_hundredths"),
            F.sum(_hundredths("match_gap_minutes")).alias("gap_hundredths"),
        )
        .withColumn("rows_written", F.lit(written).cast("bigint"))
    )


@query
def csv_export(spark, sf_dir):
    path = new_folder(spark, "top-stops")
    sinks.export_report(top_stops(spark, sf_dir), path)
    return tables.read_csv(spark, path)


@query
def csv_clean(spark, sf_dir):
    """The stops with padded header names and an empty line after every fiftieth stop, cleaned."""
    stops = adapters.feed(spark, sf_dir)["stops"]
    empty = F.struct(*[F.lit(None).cast("string").alias(c) for c in stops.columns])
    line = F.struct(*stops.columns)
    lines = F.when(F.col("stop_id").startswith("closed-"), F.array(line, empty)).otherwise(F.array(line))
    padded = stops.select(F.explode(lines).alias("line")).select("line.*").toDF(" stop_id", "stop_name  ")
    raw, clean = new_folder(spark, "raw-csv"), new_folder(spark, "clean-csv")
    sinks.write_csv(padded, raw)
    sinks.clean_csv(spark, raw, clean)
    return tables.read_csv(spark, clean)


def _catalog(spark: SparkSession, sf_dir: str, *wanted: str) -> tuple[str, str]:
    """Write and publish the wanted tables below a new folder; gives database and table prefix."""
    root, database = new_folder(spark, "catalog"), f"punctuality_{uuid.uuid4().hex}"
    sinks.write_parquet(_matched(spark, sf_dir), f"{root}/matched")
    matched = spark.read.parquet(f"{root}/matched")
    sinks.write_parquet(indicators.rollup(matched), f"{root}/rollup")
    figures = spark.read.parquet(f"{root}/rollup")
    rows = {
        "matched_observations": lambda: matched,
        "line_performance": lambda: indicators.line_performance(figures),
        "stop_performance": lambda: indicators.stop_performance(figures),
        "disruption_reasons": lambda: indicators.disruption_reasons(figures),
        "network_overview": lambda: indicators.network_overview(figures),
    }
    for name in wanted:
        sinks.write_parquet(rows[name](), f"{root}/{name}")
    catalog.create_database(spark, database, f"{root}/warehouse")
    catalog.publish(spark, database, "demo", {name: f"{root}/{name}" for name in wanted})
    return database, "demo"


@query
def catalog_publish(spark, sf_dir):
    """All five tables published; rows of each managed table and the sum of all its numbers in hundredths."""
    database, prefix = _catalog(spark, sf_dir, *catalog.TABLES)

    def facts(name: str) -> DataFrame:
        rows = spark.table(catalog.managed_table(database, prefix, name))
        numbers = [_hundredths(c) for c, kind in rows.dtypes if kind in ("bigint", "double")]
        found = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(reduce(add, numbers)).alias("hundredths"))
        return found.select(F.lit(name).alias("table_name"), "rows", "hundredths")

    return reduce(DataFrame.unionByName, [facts(name) for name in catalog.TABLES])


@query
def sql_top_lines(spark, sf_dir):
    return catalog.rank_lines(spark, *_catalog(spark, sf_dir, "line_performance"))


@query
def sql_top_stops(spark, sf_dir):
    return catalog.rank_stops(spark, *_catalog(spark, sf_dir, "stop_performance"))


@query
def sql_reasons(spark, sf_dir):
    return catalog.list_reasons(spark, *_catalog(spark, sf_dir, "disruption_reasons"))


# Collection and streaming


@query
def ingest_audit(spark, sf_dir):
    documents = snapshots.read_snapshots(spark, adapters.snapshot_folder(spark, sf_dir))
    found = audit.audit_snapshots(documents).drop("status")
    return found.withColumn("collected_at", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss"))


@query
def collection_audit(spark, sf_dir):
    """Audit next to the collector's reports: reported files, files without report, lost files, failed collections."""
    folder = adapters.snapshot_folder(spark, sf_dir)
    adapters.report_files(spark, sf_dir, folder)
    found = audit.audit_snapshots(snapshots.read_snapshots(spark, folder))
    both = audit.audit_with_reports(found, snapshots.read_collection_reports(spark, folder))
    return both.select("source_file", "visits", "status_code", "ok", "error", "reported_passages")


@query
def audit_arrivals(spark, sf_dir):
    """The collection audit by day: files arrive in two drops, the reports after the first, and days that grew are joined again."""
    arriving, told, output, checkpoint, reports_state = (
        new_folder(spark, purpose) for purpose in ("arriving", "reports", "stream-out", "stream-state", "reports-state")
    )
    documents = adapters.documents(spark, sf_dir)
    store = Store(spark, output)
    for early in (True, False):
        write_files(documents.filter((F.crc32("source_file") % 2 == 0) == early), arriving)
        collect_arrivals(spark, arriving, output, checkpoint).awaitTermination()
        audit_days(store)
        if early:
            adapters.report_files(spark, sf_dir, told)
            collect_reports(spark, told, output, reports_state).awaitTermination()
            audit_days(store)
    return read_audit(spark, output).select("source_file", "visits", "status_code", "ok", "error", "reported_passages")


@query
def published_kpis(spark, sf_dir):
    """The network's figures from a published set, read while the next set, of the undisrupted observations, is half made."""
    root, matched, seen = new_folder(spark, "published"), f"{new_folder(spark, 'matched')}/rows", []
    sinks.write_parquet(_matched(spark, sf_dir), matched)
    published, rows = Publication(spark, root), tables.read_parquet(spark, matched)
    kpis = {"kpis": lambda made: indicators.network_kpis(made["rollup"])}
    published.publish({"rollup": lambda made: indicators.rollup(rows), **kpis})

    def fails(made: Mapping[str, DataFrame]) -> DataFrame:
        seen.append(published.read()["kpis"])
        raise InterruptedError

    with contextlib.suppress(InterruptedError):
        published.publish({"rollup": lambda made: indicators.rollup(rows.filter("not is_disrupted")), "stop": fails, **kpis})
    return seen[0]


@query
def zone_seconds(spark, sf_dir):
    """Instants with Z and with offsets over a change to summer time, read in a stated zone whatever the session's is."""
    epoch = F.lit(1_711_800_000) + F.col("event_id") * 997 % 172_800
    offset = F.element_at(F.array(*map(F.lit, (0, 7_200, -19_800))), (F.col("event_id") % 3 + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, ("Z", "+02:00", "-05:30"))), (F.col("event_id") % 3 + 1).cast("int"))
    local = epoch + offset
    clock = [F.lpad((local % whole / part).cast("int").cast("string"), 2, "0") for whole, part in ((86_400, 3_600), (3_600, 60), (60, 1))]
    day = F.date_from_unix_date(F.floor(local / 86_400).cast("int")).cast("string")
    ts = instant(F.concat(day, F.lit("T"), F.concat_ws(":", *clock), name))
    return adapters.table(spark, sf_dir, "events").select(
        "event_id",
        service_day_seconds(ts, 4, "Europe/Paris").alias("service_seconds"),
        service_date(ts, 4, "Europe/Paris").cast("string").alias("service_date"),
    )


def _streamed(spark: SparkSession, sf_dir: str, drops: int = 2, after: Callable[[str], None] = lambda output: None) -> str:
    """Folder with what a stream has made of snapshots that arrive in several drops; ``after`` is called after each."""
    arriving, output, checkpoint, spans = (
        new_folder(spark, purpose) for purpose in ("arriving", "stream-out", "stream-state", "spans")
    )
    sinks.write_parquet(matching.departure_spans(_departures(spark, sf_dir)), spans)
    documents = adapters.documents(spark, sf_dir)
    for drop in range(drops):
        write_files(documents.filter(F.crc32("source_file") % drops == drop), arriving)
        match_arrivals(spark, arriving, spans, output, checkpoint).awaitTermination()
        after(output)
    return output


@query
def stream_ingest_match(spark, sf_dir):
    """Snapshots that arrive in two drops, matched incrementally."""
    return _instants_as_text(read_matches(spark, _streamed(spark, sf_dir)).drop("batch_id", "service_date"))


@query
def stream_passages(spark, sf_dir):
    """The passages that the stream stores on its way."""
    return read_passages(spark, _streamed(spark, sf_dir)).drop("batch_id", "service_date", *INSTANTS)


@query
def incremental_indicators(spark, sf_dir):
    """Line performance from the rollups of the batches, each made of its own drop alone."""
    return indicators.line_performance(read_rollups(spark, _streamed(spark, sf_dir)))


@query
def compacted_indicators(spark, sf_dir):
    """Line performance from rollups of three drops, each date made one part after the second and the third."""
    output = _streamed(spark, sf_dir, 3, lambda output: compact(Store(spark, output), 1) and None)
    return indicators.line_performance(read_rollups(spark, output))


@query
def stream_worst_samples(spark, sf_dir):
    """The worst samples from what each of three drops left of them, two of them merged; no matched row is read."""
    merged = []

    def after(output: str) -> None:
        merged.append(output)
        if len(merged) == 2:
            compact(Store(spark, output), 1)

    return ranking.worst_samples(read_samples(spark, _streamed(spark, sf_dir, 3, after)))


@query
def schedule_versions(spark, sf_dir):
    """Three loads of the schedule: all trips from the beginning; from a later date trips of even number, and then, in the place
    of that load, trips of odd number. Passages are matched to the load of their service date."""
    planned, path = _stored_departures(spark, sf_dir), f"{new_folder(spark, 'schedules')}/spans"
    schedules.load_schedule(planned, path)
    for rest in (0, 1):
        schedules.load_schedule(planned.filter(F.col("trip_id").cast("bigint") % 2 == rest), path, "2024-01-16")
    loads = [(load.valid_from, load.spans) for load in schedules.read_loads(spark, path)]
    return matching.match_to_loads(adapters.passages(spark, sf_dir), loads).select(*MATCH_COLUMNS)


@query
def rematched_indicators(spark, sf_dir):
    """Line performance after a load for later dates leaves only trips of odd number, and the passages it touches are matched
    again."""
    planned = _stored_departures(spark, sf_dir)
    arriving, output, checkpoint, root = (
        new_folder(spark, purpose) for purpose in ("arriving", "stream-out", "stream-state", "schedules")
    )
    path = f"{root}/spans"
    schedules.load_schedule(planned, path)
    write_files(adapters.documents(spark, sf_dir), arriving)
    match_arrivals(spark, arriving, path, output, checkpoint).awaitTermination()
    schedules.load_schedule(planned.filter(F.col("trip_id").cast("bigint") % 2 == 1), path, "2024-01-16")
    rematch(Store(spark, output), path)
    return indicators.line_performance(read_rollups(spark, output))


@query
def catalog_days(spark, sf_dir):
    """Matches published after each of two drops, an earlier and a later half: rows and sums of the managed table by date, and
    how often a date was rewritten."""
    database, written = f"punctuality_{uuid.uuid4().hex}", []
    arriving, output, checkpoint, spans, place = (
        new_folder(spark, purpose) for purpose in ("arriving", "stream-out", "stream-state", "spans", "warehouse")
    )
    catalog.create_database(spark, database, place)
    sinks.write_parquet(matching.departure_spans(_departures(spark, sf_dir)), spans)
    documents = adapters.documents(spark, sf_dir)
    numbered = adapters.documents(spark, sf_dir).withColumn("number", adapters.document_number())
    half = numbered.agg(F.floor((F.max("number") + 1) / 2)).first()[0]
    late = adapters.document_number() >= F.lit(half)
    for drop in (~late, late):
        write_files(documents.filter(drop), arriving)
        match_arrivals(spark, arriving, spans, output, checkpoint).awaitTermination()
        written += catalog.publish_days(Store(spark, output), "matched", database, "demo")
    times = spark.createDataFrame([(day, written.count(day)) for day in set(written)], f"{DATE} string, times_written bigint")
    managed = spark.table(catalog.managed_table(database, "demo", "daily_observations"))
    found = managed.groupBy(DATE).agg(F.count(F.lit(1)).alias("rows"), F.sum(_hundredths("delay_minutes")).alias("delay_hundredths"))
    return found.join(F.broadcast(times), DATE)


@query
def snapshot_quarantine(spark, sf_dir):
    """Drops with files cut off, files of other text, lists and empty files; every second damaged one comes again, mended.

    By file: what it was at first, how often it was taken, the beginning of its text if it is in quarantine at the end, and the
    matched rows.
    """
    arriving, mended, output, checkpoint, spans = (
        new_folder(spark, purpose) for purpose in ("arriving", "mended", "stream-out", "stream-state", "spans")
    )
    sinks.write_parquet(matching.departure_spans(_departures(spark, sf_dir)), spans)
    documents = adapters.damaged(adapters.documents(spark, sf_dir))
    for early in (True, False):
        write_files(documents.filter((F.crc32("source_file") % 2 == 0) == early), arriving)
        match_arrivals(spark, arriving, spans, output, checkpoint).awaitTermination()
    write_files(documents.filter("number % 10 >= 5").select("source_file", F.col("whole").alias("document")), mended)
    replay_mended(spark, mended, output)
    match_waiting(Store(spark, output), spans)
    first = read_documents(spark, output).groupBy("source_file").agg(
        F.max(F.when(F.col("status") != "ok", F.col("status"))).alias("damage"), F.count(F.lit(1)).alias("times_taken")
    )
    held = read_quarantine(spark, output).select("source_file", F.substring("document", 1, 8).alias("quarantined_text"))
    rows = read_matches(spark, output).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    found = first.join(held, "source_file", "left").join(rows, "source_file", "left")
    return found.select(
        "source_file",
        F.coalesce("damage", F.lit("ok")).alias("first_status"),
        "times_taken",
        "quarantined_text",
        F.coalesce("rows", F.lit(0)).alias("matched_rows"),
    )

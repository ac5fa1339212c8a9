"""The test tables in the shape of feed tables, passages and snapshot documents.

Every row of the tables used takes part. Rows that should miss a join get a key of their own instead of being left
out, so each branch of the operators is met: unknown routes and stops, quoted names, malformed times, missing
references, stops, lines and expected times, unreadable instants, every status, and observations reported twice. An
observation's stop comes from the whole table of stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.operators.passages import build_passages
from punctuality.schemas import FEED_COLUMNS
from punctuality.plans.files import write_files
from punctuality.sources.scratch import new_folder

# Events per snapshot document. Documents stay small however large the table is; their number grows instead.
EVENTS_PER_DOCUMENT = 100

ROUTES = """
    SELECT CASE WHEN n_nationkey IN (19, 24) THEN 'NET:X' || n_nationkey
                WHEN n_nationkey < 20 THEN 'NET:C' || lpad(CAST(n_nationkey + 1 AS STRING), 5, '0')
                ELSE 'NET:R' || n_nationkey END AS route_id,
           n_name AS route_short_name
    FROM {nation}
"""

TRIPS = """
    SELECT CASE WHEN o_custkey % 25 < 20 THEN 'NET:C' || lpad(CAST(o_custkey % 25 + 1 AS STRING), 5, '0')
                ELSE 'NET:R' || (o_custkey % 25) END AS route_id,
           CAST(o_orderkey AS STRING) AS trip_id
    FROM {orders}
"""

STOPS = """
    SELECT CASE WHEN p_partkey % 50 = 0 THEN 'closed-' ELSE '' END || p_partkey AS stop_id,
           CASE WHEN p_partkey % 11 = 3 THEN chr(34) || p_name || chr(34) || ', quai ' || chr(92) || ' 2'
                WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ' ELSE replace(p_name, ' ', '-') END AS stop_name
    FROM {part}
"""

STOP_TIMES = """
    SELECT CAST(l_orderkey AS STRING) AS trip_id,
           CAST(l_partkey AS STRING) AS stop_id,
           CASE WHEN l_partkey % 97 = 0 THEN '7:05'
                ELSE lpad(CAST(s div 3600 AS STRING), 2, '0') || ':'
                     || lpad(CAST(s div 60 % 60 AS STRING), 2, '0') || ':'
                     || lpad(CAST(s % 60 AS STRING), 2, '0') END AS departure_time
    FROM (SELECT l_orderkey, l_partkey,
                 (l_orderkey * 37 + l_partkey * 7919 + l_linenumber * 3571) % 79200 + 14400 AS s
          FROM {lineitem})
"""

# One visit per event, and a second report of every fiftieth observation: another vehicle on the same line.
VISITS = """
    SELECT 'snapshot_REF_StopPoint_Q_' || document || '__'
               || date_format(date_add(DATE '2024-01-01', CAST(document div 86400 AS INT)), 'yyyyMMdd') || '_'
               || lpad(CAST(document div 3600 % 24 AS STRING), 2, '0')
               || lpad(CAST(document div 60 % 60 AS STRING), 2, '0')
               || lpad(CAST(document % 60 AS STRING), 2, '0') || '.json' AS source_file,
           document,
           date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") AS recorded_at_time,
           CASE WHEN event_id % 83 <> 5 THEN 'REF:StopPoint:Q:' || stop_number || ':' END AS monitoring_ref,
           CASE WHEN event_id % 61 = 7 THEN NULL WHEN report = 1 AND event_id % 100 = 1 THEN 'ALT:' ELSE '' END
               || CASE WHEN line < 20 THEN 'REF:Line::C' || lpad(CAST(line + 1 AS STRING), 5, '0') || ':'
                       ELSE 'NATION_' || line END
               || CASE WHEN report = 1 AND event_id % 100 <> 1 THEN 'bis' ELSE '' END AS line_ref,
           CASE WHEN event_id % 71 <> 3 THEN p_name END AS stop_point_name,
           CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 43 = 9 THEN 'soon'
                ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") END AS expected_departure_time,
           CASE WHEN report = 1 THEN CASE WHEN event_id % 100 = 1 THEN 'Cancelled' ELSE 'noReport' END
                WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Cancelled' ELSE 'onTime' END
                WHEN event_type = 'signup' THEN 'noReport'
                WHEN event_type = 'click' THEN NULL
                ELSE 'onTime' END AS departure_status,
           CASE WHEN report = 1 THEN NULL
                WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'cancelled' END
                WHEN event_type = 'view' THEN 'NOREPORT'
                WHEN event_type = 'click' THEN NULL
                ELSE 'onTime' END AS arrival_status
    FROM (SELECT event_id, event_type, ts, user_id % 25 AS line, event_id div {size} AS document,
                 event_id % (SELECT count(*) FROM {part}) AS stop_number,
                 explode(CASE WHEN event_id % 50 = 1 THEN array(0, 1) ELSE array(0) END) AS report
          FROM {events})
    LEFT JOIN {part} ON p_partkey = stop_number
"""


# Columns in use. Stated, so that opening a table needs no job that looks into its files.
LAYOUTS = {
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_type string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """routes, trips, stops and stop_times."""
    sources = {"routes": ("nation", ROUTES), "trips": ("orders", TRIPS), "stops": ("part", STOPS)}
    sources["stop_times"] = ("lineitem", STOP_TIMES)
    return {
        name: spark.sql(text, **{source: table(spark, sf_dir, source)}).select(*FEED_COLUMNS[name])
        for name, (source, text) in sources.items()
    }


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat visits, as flattening the snapshot documents gives them, plus the document number."""
    sources = {name: table(spark, sf_dir, name) for name in ("events", "part")}
    return spark.sql(VISITS, size=EVENTS_PER_DOCUMENT, **sources)


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_passages(visits(spark, sf_dir).drop("document"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_file and snapshot document as JSON text: all visits in one delivery, a second delivery without any,
    and in every seventh document a third one whose list is missing. Missing fields are left out."""
    value = lambda c: F.struct(F.col(c).alias("value"))
    call = F.struct(
        F.array(value("stop_point_name")).alias("StopPointName"),
        F.col("expected_departure_time").alias("ExpectedDepartureTime"),
        F.col("departure_status").alias("DepartureStatus"),
        F.col("arrival_status").alias("ArrivalStatus"),
    )
    journey = F.struct(value("line_ref").alias("LineRef"), call.alias("MonitoredCall"))
    visit = F.struct(
        F.col("recorded_at_time").alias("RecordedAtTime"),
        value("monitoring_ref").alias("MonitoringRef"),
        journey.alias("MonitoredVehicleJourney"),
    )
    # At most EVENTS_PER_DOCUMENT events meet in one list.
    gathered = (
        visits(spark, sf_dir)
        .groupBy("source_file", "document")
        .agg(F.collect_list(visit).alias("visits"))
    )

    def delivery(items):
        return F.struct(items.alias("MonitoredStopVisit"))

    kind = gathered.schema["visits"].dataType.simpleString()
    full, empty, missing = (
        delivery(items) for items in (F.col("visits"), F.array().cast(kind), F.lit(None).cast(kind))
    )
    deliveries = F.when(F.col("document") % 7 == 3, F.array(full, empty, missing)).otherwise(F.array(full, empty))
    service = F.struct(deliveries.alias("StopMonitoringDelivery"))
    siri = F.struct(F.struct(service.alias("ServiceDelivery")).alias("Siri"))
    return gathered.select("source_file", F.to_json(siri).alias("document"))


def document_number() -> Column:
    """The number of a document in its file name."""
    return F.regexp_extract("source_file", r"_Q_(\d+)__", 1).cast("bigint")


def damaged(documents: DataFrame) -> DataFrame:
    """The documents with their number, their text as it should be in ``whole``, and as it arrives in ``document``: four of
    five are cut off in the middle, another text, a list, or a space."""
    text = F.col("document")
    arrived = (
        F.when(F.col("number") % 5 == 1, F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")))
        .when(F.col("number") % 5 == 2, F.concat(F.lit("HTTP 502 "), F.col("source_file")))
        .when(F.col("number") % 5 == 3, F.concat(F.lit("["), text, F.lit("]")))
        .when(F.col("number") % 5 == 4, F.lit(" "))
        .otherwise(text)
    )
    return documents.withColumns({"number": document_number(), "whole": text}).withColumn("document", arrived)


def snapshot_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the documents as snapshot files into a new folder."""
    folder = new_folder(spark, "snapshots")
    write_files(documents(spark, sf_dir), folder)
    return folder


def report_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the collector's reports beside the snapshots, a file for every fifty documents.

    Every fifth document has no report; besides, some reports are of failed collections or of files that are lost.
    """
    held = visits(spark, sf_dir).groupBy("source_file", "document").agg(F.count(F.lit(1)).alias("visits"))
    number = F.col("document").cast("string")
    entry = lambda file, code, ok, error, n: F.struct(
        file.cast("string").alias("snapshot_file"),
        F.lit(code).alias("status_code"),
        F.lit(ok).alias("ok"),
        F.lit(error).cast("string").alias("error"),
        n.cast("int").alias("nb_passages"),
    )
    told = F.filter(
        F.array(
            F.when(F.col("document") % 5 != 1, entry(F.col("source_file"), 200, True, None, F.col("visits"))),
            F.when(F.col("document") % 6 == 2, entry(F.lit(None), 503, False, "HTTP 503", F.lit(0))),
            F.when(F.col("document") % 7 == 4, entry(F.concat(F.lit("snapshot_lost_"), number, F.lit(".json")), 200, True, None, F.lit(0))),
        ),
        lambda x: x.isNotNull(),
    )
    batch = F.floor(F.col("document") / 50)
    listed = held.groupBy(batch.alias("batch")).agg(F.flatten(F.collect_list(told)).alias("entries"))
    stamp = F.lpad(F.col("batch").cast("string"), 8, "0")
    name = F.concat(F.lit("collection_report_"), stamp, F.lit("_000000.json"))
    write_files(listed.select(name.alias("source_file"), F.to_json("entries").alias("document")), folder)

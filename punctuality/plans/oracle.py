"""DuckDB SQL for the registered queries.

Written independently of the library: the match compares all pairs within line and stop and ranks them, and rounding
goes through decimal text.
"""

from __future__ import annotations

from punctuality.plans.adapters import EVENTS_PER_DOCUMENT

TABLES = f"""
routes AS (
    SELECT CASE WHEN n_nationkey IN (19, 24) THEN 'NET:X' || n_nationkey
                WHEN n_nationkey < 20 THEN 'NET:C' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 5, '0')
                ELSE 'NET:R' || n_nationkey END AS route_id,
           n_name AS route_short_name
    FROM nation),
trips AS (
    SELECT CASE WHEN o_custkey % 25 < 20 THEN 'NET:C' || lpad(CAST(o_custkey % 25 + 1 AS VARCHAR), 5, '0')
                ELSE 'NET:R' || (o_custkey % 25) END AS route_id,
           CAST(o_orderkey AS VARCHAR) AS trip_id
    FROM orders),
stops AS (
    SELECT CASE WHEN p_partkey % 50 = 0 THEN 'closed-' ELSE '' END || p_partkey AS stop_id,
           CASE WHEN p_partkey % 11 = 3 THEN chr(34) || p_name || chr(34) || ', quai ' || chr(92) || ' 2'
                WHEN p_partkey % 2 = 0 THEN upper(p_name) || ' ' ELSE replace(p_name, ' ', '-') END AS stop_name
    FROM part),
stop_times AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
           CAST(l_partkey AS VARCHAR) AS stop_id,
           CASE WHEN l_partkey % 97 = 0 THEN '7:05'
                ELSE lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':'
                     || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':'
                     || lpad(CAST(s % 60 AS VARCHAR), 2, '0') END AS departure_time
    FROM (SELECT l_orderkey, l_partkey,
                 (l_orderkey * 37 + l_partkey * 7919 + l_linenumber * 3571) % 79200 + 14400 AS s
          FROM lineitem)),
visits AS (
    SELECT 'snapshot_REF_StopPoint_Q_' || document || '__'
               || strftime(DATE '2024-01-01' + CAST(document // 86400 AS INTEGER), '%Y%m%d') || '_'
               || lpad(CAST(document // 3600 % 24 AS VARCHAR), 2, '0')
               || lpad(CAST(document // 60 % 60 AS VARCHAR), 2, '0')
               || lpad(CAST(document % 60 AS VARCHAR), 2, '0') || '.json' AS source_file,
           document,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS recorded_at_time,
           CASE WHEN event_id % 83 <> 5 THEN 'REF:StopPoint:Q:' || stop_number || ':' END AS monitoring_ref,
           CASE WHEN event_id % 61 = 7 THEN NULL WHEN report = 1 AND event_id % 100 = 1 THEN 'ALT:' ELSE '' END
               || CASE WHEN line < 20 THEN 'REF:Line::C' || lpad(CAST(line + 1 AS VARCHAR), 5, '0') || ':'
                       ELSE 'NATION_' || line END
               || CASE WHEN report = 1 AND event_id % 100 <> 1 THEN 'bis' ELSE '' END AS line_ref,
           CASE WHEN event_id % 71 <> 3 THEN p_name END AS stop_point_name,
           CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 43 = 9 THEN 'soon'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS expected_departure_time,
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
    FROM (SELECT event_id, event_type, ts, user_id % 25 AS line, event_id // {EVENTS_PER_DOCUMENT} AS document,
                 event_id % (SELECT count(*) FROM part) AS stop_number,
                 unnest(CASE WHEN event_id % 50 = 1 THEN [0, 1] ELSE [0] END) AS report
          FROM events)
    LEFT JOIN part ON p_partkey = stop_number)
"""

CODE = "CASE WHEN regexp_matches({ref}, 'C[0-9]+') THEN regexp_extract({ref}, 'C[0-9]+') ELSE {other} END"
PLACE = "replace(replace(replace(replace(replace(replace(lower(trim({name})), '-', ' '), '''', ' '), chr(92), ' '), '*', ' '), '(', ' '), ')', ' ')"
DAY_SECONDS = (
    "CAST(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
    " + CASE WHEN hour({ts}) < 4 THEN 86400 ELSE 0 END AS INTEGER)"
)
# Half up on the shortest decimal text of the number.
ROUNDED = "CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


def rate(flag: str) -> str:
    hits = f"CAST(count(*) FILTER (WHERE {flag}) AS DOUBLE)"
    return ROUNDED.format(x=f"({hits} / count(*) * 100)")


def share(part: str, total: str) -> str:
    return f"CASE WHEN {total} <> 0 THEN {ROUNDED.format(x=f'(CAST({part} AS DOUBLE) / {total} * 100)')} ELSE 0.0 END"


MEAN_DELAY = ROUNDED.format(x="(CAST(sum(CAST(round(delay_minutes * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100))")

SCHEDULE = f"""
schedule AS (
    SELECT DISTINCT {CODE.format(ref="trips.route_id", other="route_short_name")} AS line_code,
           route_short_name, trip_id, stop_name, departure_time
    FROM trips
    LEFT JOIN routes USING (route_id)
    JOIN stop_times USING (trip_id)
    LEFT JOIN stops USING (stop_id)
    WHERE {CODE.format(ref="trips.route_id", other="route_short_name")} IS NOT NULL AND stop_name IS NOT NULL),
planned AS (
    SELECT * FROM (
        SELECT *, {PLACE.format(name="stop_name")} AS stop_key,
               CASE WHEN regexp_full_match(departure_time, '[0-9]+:[0-9]+:[0-9]+')
                    THEN CAST(split_part(departure_time, ':', 1) AS INTEGER) * 3600
                         + CAST(split_part(departure_time, ':', 2) AS INTEGER) * 60
                         + CAST(split_part(departure_time, ':', 3) AS INTEGER) END AS planned_seconds
        FROM schedule)
    WHERE planned_seconds IS NOT NULL)
"""

PASSAGES = f"""
passages AS (
    SELECT *, {CODE.format(ref="line_ref", other="line_ref")} AS line_code,
           TRY_CAST(recorded_at_time AS TIMESTAMP) AS recorded_at_ts,
           TRY_CAST(expected_departure_time AS TIMESTAMP) AS expected_departure_ts
    FROM visits
    WHERE monitoring_ref IS NOT NULL AND stop_point_name IS NOT NULL),
placed AS (
    SELECT *, {PLACE.format(name="stop_point_name")} AS stop_key,
           {DAY_SECONDS.format(ts="expected_departure_ts")} AS expected_seconds,
           lower(departure_status) = 'cancelled' OR lower(arrival_status) = 'cancelled' AS is_cancelled,
           lower(departure_status) = 'noreport' OR lower(arrival_status) = 'noreport' AS is_unreported
    FROM passages
    WHERE line_code IS NOT NULL AND expected_departure_ts IS NOT NULL)
"""


def matches(tolerance: int, holds: str = "TRUE") -> str:
    return f"""
ranked AS (
    SELECT placed.*, trip_id, departure_time, route_short_name, planned_seconds,
           row_number() OVER (
               PARTITION BY source_file, recorded_at_time, monitoring_ref, line_code, stop_point_name,
                            expected_departure_time
               ORDER BY abs(expected_seconds - planned_seconds), planned_seconds, trip_id, departure_time,
                        route_short_name NULLS FIRST, stop_name,
                        CASE WHEN is_cancelled THEN 0 WHEN is_cancelled IS NULL THEN 1 ELSE 2 END,
                        CASE WHEN is_unreported THEN 0 WHEN is_unreported IS NULL THEN 1 ELSE 2 END) AS place
    FROM placed JOIN planned USING (line_code, stop_key) WHERE {holds}),
nearest AS (
    SELECT * FROM ranked WHERE place = 1 AND abs(expected_seconds - planned_seconds) <= {tolerance})
"""


MATCHED = """
flagged AS (
    SELECT *, round((expected_seconds - planned_seconds) / CAST(60 AS DOUBLE), 2) AS delay_minutes,
           round(abs(expected_seconds - planned_seconds) / CAST(60 AS DOUBLE), 2) AS match_gap_minutes
    FROM nearest),
matched AS (
    SELECT source_file, recorded_at_time, recorded_at_ts, monitoring_ref, line_code, route_short_name,
           stop_point_name, expected_departure_time, expected_departure_ts, departure_time, match_gap_minutes,
           delay_minutes, delay_minutes >= 5 AS is_delayed, is_cancelled,
           disruption_reason <> 'normal' AS is_disrupted, disruption_reason
    FROM (SELECT *, CASE WHEN is_cancelled THEN 'cancelled_service'
                         WHEN delay_minutes >= 5 THEN 'delay'
                         WHEN is_unreported THEN 'missing_realtime_status'
                         ELSE 'normal' END AS disruption_reason
          FROM flagged))
"""

MATCHED_TEXT = """
    SELECT * REPLACE (strftime(recorded_at_ts, '%Y-%m-%d %H:%M:%S.%f') AS recorded_at_ts,
                      strftime(expected_departure_ts, '%Y-%m-%d %H:%M:%S.%f') AS expected_departure_ts)
    FROM matched
"""


def by_line(source: str = "matched") -> str:
    return f"""
lines AS (
    SELECT line_code, route_short_name, count(*) AS observations, {MEAN_DELAY} AS avg_delay_minutes,
           {rate("is_delayed")} AS delay_rate_pct, {rate("is_disrupted")} AS disruption_rate_pct
    FROM {source} GROUP BY ALL)
"""


BY_STOP = f"""
stop_rows AS (
    SELECT stop_point_name, count(*) AS observations, {MEAN_DELAY} AS avg_delay_minutes,
           {rate("is_disrupted")} AS disruption_rate_pct
    FROM matched GROUP BY ALL)
"""

TITLE = """
CASE {c} WHEN 'cancelled_service' THEN 'Service annule' WHEN 'missing_realtime_status' THEN 'Statut temps reel manquant'
         WHEN 'delay' THEN 'Retard' ELSE 'Normal' END
"""

REASONS = f"""
reasons AS (
    SELECT disruption_reason, count(*) AS events, {TITLE.format(c="disruption_reason")} AS motif,
           {share("count(*)", "(SELECT count(*) FROM matched WHERE is_disrupted)")} AS share_pct
    FROM matched WHERE is_disrupted GROUP BY disruption_reason
    ORDER BY events DESC, disruption_reason LIMIT 8)
"""


def most_disrupted(source: str, shown: str, key: str) -> str:
    rows = f"SELECT * FROM {source} WHERE disruption_rate_pct > 0 OR NOT EXISTS (SELECT 1 FROM {source} WHERE disruption_rate_pct > 0)"
    return f"""
    SELECT {shown} FROM ({rows})
    ORDER BY CASE WHEN disruption_rate_pct > 0 THEN disruption_rate_pct END DESC NULLS LAST,
             observations DESC NULLS LAST, avg_delay_minutes DESC NULLS LAST, {key}
    LIMIT 6
"""


LINE_SHOWN = """
line_code || CASE WHEN route_short_name <> line_code THEN ' (' || route_short_name || ')' ELSE '' END AS line,
observations, avg_delay_minutes, delay_rate_pct, disruption_rate_pct
"""
TOP_LINES = most_disrupted("lines", LINE_SHOWN, "line_code NULLS FIRST, route_short_name NULLS FIRST")
TOP_STOPS = most_disrupted("stop_rows", "*", "stop_point_name NULLS FIRST")

ODD_TRIPS_LATER = "CAST(expected_departure_ts - INTERVAL 4 HOUR AS DATE) < DATE '2024-01-16' OR CAST(trip_id AS BIGINT) % 2 = 1"
MATCH = [TABLES, SCHEDULE, PASSAGES, matches(7200)]
VERDICT = [*MATCH, MATCHED]
MATCH_COLUMNS = """
    SELECT source_file, recorded_at_time, monitoring_ref, line_code, stop_point_name, expected_departure_time,
           is_cancelled, is_unreported, trip_id, departure_time, route_short_name,
           expected_seconds, planned_seconds
    FROM nearest
"""


def sql(steps: list[str], select: str) -> str:
    return "WITH " + ",".join(step.strip() for step in steps) + "\n" + select.strip()


SCHEDULE_ROWS = sql(
    [TABLES, SCHEDULE], "SELECT line_code, route_short_name, trip_id, stop_name, departure_time FROM schedule"
)
NEAREST_ROWS = sql(MATCH, MATCH_COLUMNS)
MATCHED_ROWS = sql(VERDICT, MATCHED_TEXT)
NAME = "concat('', ' ', p_name, ' - l''Arrêt', chr(92), '(', p_type, ')* ')"

KPIS = f"""
    SELECT *, {share("delayed_observations", "total_observations")} AS delay_rate_pct,
           {share("disrupted_observations", "total_observations")} AS disruption_rate_pct,
           {share("cancelled_observations", "total_observations")} AS cancellation_rate_pct
    FROM (SELECT count(*) AS total_observations, count(DISTINCT line_code) AS distinct_lines,
                 count(DISTINCT stop_point_name) AS distinct_stops,
                 count(*) FILTER (WHERE is_delayed) AS delayed_observations,
                 count(*) FILTER (WHERE is_disrupted) AS disrupted_observations,
                 count(*) FILTER (WHERE is_cancelled) AS cancelled_observations,
                 {MEAN_DELAY} AS network_avg_delay_minutes
          FROM matched)
"""

ORACLE: dict[str, str] = {
    "schedule_build": SCHEDULE_ROWS,
    "schedule_from_csv": SCHEDULE_ROWS,
    "schedule_seconds": sql(
        [TABLES, SCHEDULE], "SELECT line_code, stop_key, trip_id, departure_time, planned_seconds FROM planned"
    ),
    "observations_flatten": sql(
        [TABLES, PASSAGES], "SELECT * EXCLUDE (document, recorded_at_ts, expected_departure_ts) FROM passages"
    ),
    "observations_parse_time": sql(
        [TABLES],
        f"""
        SELECT source_file, recorded_at_time,
               {DAY_SECONDS.format(ts="TRY_CAST(recorded_at_time AS TIMESTAMP)")} AS recorded_seconds,
               expected_departure_time,
               {DAY_SECONDS.format(ts="TRY_CAST(expected_departure_time AS TIMESTAMP)")} AS expected_seconds
        FROM visits
        """,
    ),
    "line_code_extract": sql(
        [TABLES],
        f"""
        SELECT reference, fallback, {CODE.format(ref="reference", other="fallback")} AS line_code, count(*) AS rows
        FROM (SELECT trips.route_id AS reference, route_short_name AS fallback
              FROM trips LEFT JOIN routes USING (route_id)
              UNION ALL
              SELECT line_ref, line_ref FROM visits)
        GROUP BY ALL
        """,
    ),
    "stop_name_normalize": f"""
        SELECT p_partkey, {PLACE.format(name=NAME)} AS stop_key,
               regexp_replace({PLACE.format(name=NAME)}, '\\s+', ' ', 'g') AS stop_key_collapsed
        FROM part
    """,
    "candidate_pairs": sql(
        [TABLES, SCHEDULE, PASSAGES],
        """
        SELECT line_code, CAST(count(DISTINCT stop_key) AS VARCHAR) AS stops,
               CAST(sum(observed_rows) AS VARCHAR) AS observed_rows, CAST(sum(planned_rows) AS VARCHAR) AS planned_rows,
               CAST(sum(pairs) AS VARCHAR) AS candidate_pairs, CAST(sum(inside) AS VARCHAR) AS pairs_in_tolerance,
               CAST(sum(gap) AS VARCHAR) AS gap_seconds
        FROM (SELECT line_code, stop_key, count(*) AS pairs,
                     count(*) FILTER (WHERE abs(expected_seconds - planned_seconds) <= 7200) AS inside,
                     sum(abs(expected_seconds - planned_seconds)) AS gap
              FROM placed JOIN planned USING (line_code, stop_key) GROUP BY ALL)
        JOIN (SELECT line_code, stop_key, count(*) AS observed_rows FROM placed GROUP BY ALL)
             USING (line_code, stop_key)
        JOIN (SELECT line_code, stop_key, count(*) AS planned_rows FROM planned GROUP BY ALL)
             USING (line_code, stop_key)
        GROUP BY line_code
        """,
    ),
    "nearest_match": NEAREST_ROWS,
    "nearest_match_window": NEAREST_ROWS,
    "nearest_match_stored": NEAREST_ROWS,
    "nearest_match_bucketed": sql([TABLES, SCHEDULE, PASSAGES, matches(900)], MATCH_COLUMNS),
    "matched_classified": MATCHED_ROWS,
    "line_performance": sql([*VERDICT, by_line()], "SELECT * FROM lines"),
    "stop_performance": sql([*VERDICT, BY_STOP], "SELECT * FROM stop_rows"),
    "disruption_reasons": sql(
        VERDICT, "SELECT disruption_reason, count(*) AS events FROM matched GROUP BY disruption_reason"
    ),
    "network_overview": sql(
        VERDICT,
        f"""
        SELECT count(*) AS total_observations, count(*) FILTER (WHERE is_disrupted) AS disrupted_observations,
               count(*) FILTER (WHERE is_cancelled) AS cancelled_observations,
               {MEAN_DELAY} AS network_avg_delay_minutes
        FROM matched
        """,
    ),
    "network_kpis": sql(VERDICT, KPIS),
    "reason_share": sql([*VERDICT, REASONS], "SELECT * FROM reasons"),
    "top_lines": sql([*VERDICT, by_line()], TOP_LINES),
    "top_stops": sql([*VERDICT, BY_STOP], TOP_STOPS),
    "top_lines_fallback": sql([*VERDICT, by_line("(SELECT * FROM matched WHERE NOT is_disrupted)")], TOP_LINES),
    "chart_series": sql(
        [*VERDICT, by_line(), BY_STOP, REASONS],
        f"""
        SELECT 'top_lines' AS chart, line AS label, disruption_rate_pct AS value FROM ({TOP_LINES})
        UNION ALL SELECT 'top_stops', stop_point_name, disruption_rate_pct FROM ({TOP_STOPS})
        UNION ALL SELECT 'disruption_reasons', motif, CAST(events AS DOUBLE) FROM reasons
        """,
    ),
    "worst_samples": sql(
        VERDICT,
        f"""
        SELECT line_code, stop_point_name, expected_departure_time, delay_minutes,
               {TITLE.format(c="disruption_reason")} AS disruption_reason
        FROM (SELECT * FROM matched WHERE is_disrupted
              ORDER BY delay_minutes DESC, line_code, stop_point_name, expected_departure_time,
                       disruption_reason LIMIT 10)
        """,
    ),
    "parquet_publish": sql(
        VERDICT,
        """
        SELECT strftime(expected_departure_ts - INTERVAL 4 HOUR, '%Y-%m-%d') AS service_date, count(*) AS rows,
               CAST(sum(CAST(round(delay_minutes * 100) AS BIGINT)) AS BIGINT) AS delay_hundredths,
               CAST(sum(CAST(round(match_gap_minutes * 100) AS BIGINT)) AS BIGINT) AS gap_hundredths,
               (SELECT count(*) FROM matched) AS rows_written
        FROM matched GROUP BY ALL
        """,
    ),
    "csv_export": sql([*VERDICT, BY_STOP], f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({TOP_STOPS})"),
    "csv_clean": sql([TABLES], "SELECT stop_id, stop_name FROM stops"),
    "catalog_publish": sql(
        [*VERDICT, by_line(), BY_STOP],
        f"""
        SELECT 'matched_observations' AS table_name, count(*) AS rows,
               CAST(sum(CAST(round(match_gap_minutes * 100) AS BIGINT) + CAST(round(delay_minutes * 100) AS BIGINT)) AS BIGINT) AS hundredths
        FROM matched
        UNION ALL SELECT 'line_performance', count(*),
               CAST(sum(observations * 100 + CAST(round(avg_delay_minutes * 100) AS BIGINT)
                        + CAST(round(delay_rate_pct * 100) AS BIGINT) + CAST(round(disruption_rate_pct * 100) AS BIGINT)) AS BIGINT)
        FROM lines
        UNION ALL SELECT 'stop_performance', count(*),
               CAST(sum(observations * 100 + CAST(round(avg_delay_minutes * 100) AS BIGINT)
                        + CAST(round(disruption_rate_pct * 100) AS BIGINT)) AS BIGINT)
        FROM stop_rows
        UNION ALL SELECT 'disruption_reasons', count(*), CAST(sum(events * 100) AS BIGINT)
        FROM (SELECT disruption_reason, count(*) AS events FROM matched GROUP BY disruption_reason)
        UNION ALL SELECT 'network_overview', count(*),
               CAST(sum(total * 100 + disrupted * 100 + cancelled * 100 + CAST(round(mean * 100) AS BIGINT)) AS BIGINT)
        FROM (SELECT count(*) AS total, count(*) FILTER (WHERE is_disrupted) AS disrupted,
                     count(*) FILTER (WHERE is_cancelled) AS cancelled, {MEAN_DELAY} AS mean FROM matched)
        """,
    ),
    "sql_top_lines": sql(
        [*VERDICT, by_line()],
        """
        SELECT line_code, route_short_name, disruption_rate_pct, avg_delay_minutes FROM lines
        ORDER BY disruption_rate_pct DESC, avg_delay_minutes DESC, line_code, route_short_name NULLS FIRST LIMIT 10
        """,
    ),
    "sql_top_stops": sql(
        [*VERDICT, BY_STOP],
        """
        SELECT stop_point_name, disruption_rate_pct, avg_delay_minutes FROM stop_rows
        ORDER BY disruption_rate_pct DESC, avg_delay_minutes DESC, stop_point_name LIMIT 10
        """,
    ),
    "sql_reasons": sql(
        VERDICT,
        "SELECT disruption_reason, count(*) AS events FROM matched GROUP BY ALL ORDER BY events DESC, 1",
    ),
    "ingest_audit": sql(
        [TABLES],
        """
        SELECT source_file, replace('REF_StopPoint_Q_' || document || '_', '_', ':') AS monitoring_ref,
               strftime(strptime(split_part(split_part(source_file, '__', 2), '.', 1), '%Y%m%d_%H%M%S'),
                        '%Y-%m-%d %H:%M:%S') AS collected_at,
               CAST(CASE WHEN document % 7 = 3 THEN 3 ELSE 2 END AS INTEGER) AS deliveries,
               CAST(count(*) AS INTEGER) AS nb_passages, CAST(count(*) AS INTEGER) AS visits,
               CAST(count(*) FILTER (WHERE stop_point_name IS NOT NULL AND monitoring_ref IS NOT NULL) AS INTEGER)
                   AS usable_visits,
               CAST(count(*) FILTER (WHERE expected_departure_time IS NULL
                                       AND (lower(departure_status) = 'cancelled' OR lower(arrival_status) = 'cancelled'))
                    AS INTEGER) AS cancelled_without_time,
               min(recorded_at_time) AS first_recorded_at, max(recorded_at_time) AS last_recorded_at
        FROM visits GROUP BY source_file, document
        """,
    ),
    "collection_audit": sql(
        [TABLES],
        """
        SELECT CASE WHEN kind = 'failed' THEN NULL WHEN kind = 'lost' THEN 'snapshot_lost_' || document || '.json'
                    ELSE source_file END AS source_file,
               CASE WHEN kind NOT IN ('failed', 'lost') THEN visits END AS visits,
               CASE WHEN kind = 'reported' THEN 200 WHEN kind = 'lost' THEN 200 WHEN kind = 'failed' THEN 503 END AS status_code,
               CASE WHEN kind = 'failed' THEN FALSE WHEN kind <> 'silent' THEN TRUE END AS ok,
               CASE WHEN kind = 'failed' THEN 'HTTP 503' END AS error,
               CASE WHEN kind = 'reported' THEN visits WHEN kind IN ('lost', 'failed') THEN 0 END AS reported_passages
        FROM (SELECT source_file, document, visits, unnest(list_concat(
                         [CASE WHEN document % 5 = 1 THEN 'silent' ELSE 'reported' END],
                         CASE WHEN document % 6 = 2 THEN ['failed'] ELSE [] END,
                         CASE WHEN document % 7 = 4 THEN ['lost'] ELSE [] END)) AS kind
              FROM (SELECT source_file, document, CAST(count(*) AS INTEGER) AS visits FROM visits GROUP BY ALL))
        """,
    ),
    "zone_seconds": """
        SELECT event_id, CAST((epoch + shift) % 86400
                   + CASE WHEN (epoch + shift) % 86400 < 14400 THEN 86400 ELSE 0 END AS INTEGER) AS service_seconds,
               strftime(DATE '1970-01-01' + CAST((epoch + shift - 14400) // 86400 AS INTEGER), '%Y-%m-%d') AS service_date
        FROM (SELECT event_id, epoch, CASE WHEN epoch < change THEN winter ELSE winter + 3600 END AS shift
              FROM (SELECT event_id, 1711800000 + event_id * 997 % 172800 AS epoch, 1711846800 AS change, 3600 AS winter
                    FROM events))
    """,
    "stream_ingest_match": MATCHED_ROWS,
    "stream_passages": sql(
        [TABLES, PASSAGES], "SELECT * EXCLUDE (document, recorded_at_ts, expected_departure_ts) FROM passages"
    ),
    "incremental_indicators": sql([*VERDICT, by_line()], "SELECT * FROM lines"),
    "compacted_indicators": sql([*VERDICT, by_line()], "SELECT * FROM lines"),
    "schedule_versions": sql([TABLES, SCHEDULE, PASSAGES, matches(7200, ODD_TRIPS_LATER)], MATCH_COLUMNS),
    "rematched_indicators": sql([TABLES, SCHEDULE, PASSAGES, matches(7200, ODD_TRIPS_LATER), MATCHED, by_line()], "SELECT * FROM lines"),
    "catalog_days": sql(
        VERDICT,
        """
        SELECT strftime(expected_departure_ts - INTERVAL 4 HOUR, '%Y-%m-%d') AS service_date, count(*) AS rows,
               CAST(sum(CAST(round(delay_minutes * 100) AS BIGINT)) AS BIGINT) AS delay_hundredths,
               count(DISTINCT number >= half) AS times_written
        FROM (SELECT *, CAST(regexp_extract(source_file, '_Q_([0-9]+)__', 1) AS BIGINT) AS number FROM matched),
             (SELECT (max(document) + 1) // 2 AS half FROM visits)
        GROUP BY ALL
        """,
    ),
    "snapshot_quarantine": sql(
        VERDICT,
        """
        SELECT source_file,
               CASE document % 5 WHEN 0 THEN 'ok' WHEN 3 THEN 'not_an_object' WHEN 4 THEN 'empty' ELSE 'unreadable' END AS first_status,
               CAST(CASE WHEN mended THEN 2 ELSE 1 END AS BIGINT) AS times_taken,
               CASE WHEN NOT mended THEN CASE document % 5 WHEN 1 THEN '{"Siri":' WHEN 2 THEN 'HTTP 502' WHEN 3 THEN '[{"Siri"' WHEN 4 THEN ' ' END END
                   AS quarantined_text,
               CASE WHEN document % 5 = 0 OR mended THEN coalesce(n, 0) ELSE 0 END AS matched_rows
        FROM (SELECT source_file, document, document % 5 <> 0 AND document % 10 >= 5 AS mended FROM visits GROUP BY ALL)
        LEFT JOIN (SELECT source_file, count(*) AS n FROM matched GROUP BY source_file) USING (source_file)
        """,
    ),
}

ORACLE["stream_worst_samples"] = ORACLE["worst_samples"]
ORACLE["audit_arrivals"] = ORACLE["collection_audit"]
ORACLE["published_kpis"] = ORACLE["network_kpis"]

"""Catalog tables over the datasets: external Parquet tables, managed ORC copies, ranking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctuality import schemas
from punctuality.sources.store import DATE, Store

# Published tables and their layouts.
TABLES = {
    "matched_observations": schemas.MATCHED,
    "line_performance": schemas.LINE_PERFORMANCE,
    "stop_performance": schemas.STOP_PERFORMANCE,
    "disruption_reasons": schemas.DISRUPTION_REASONS,
    "network_overview": schemas.NETWORK_OVERVIEW,
}


def managed_table(database: str, prefix: str, table: str) -> str:
    return f"{database}.{prefix}_{table}"


def external_table(database: str, prefix: str, table: str) -> str:
    return managed_table(database, prefix, table) + "_ext"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is missing; managed tables go below ``location`` if one is given."""
    if location is None:
        spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": database})
    else:
        spark.sql(
            "CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) LOCATION :place",
            args={"name": database, "place": location},
        )


def publish(spark: SparkSession, database: str, prefix: str, locations: dict[str, str]) -> None:
    """For each table → Parquet location: register it as an external table and reload its managed ORC copy.

    Columns are matched by name in the reload, so a dataset whose columns moved cannot end up in the wrong ones.
    """
    for table, location in locations.items():
        layout = TABLES[table]
        external, managed = external_table(database, prefix, table), managed_table(database, prefix, table)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({layout}) USING parquet LOCATION :place",
            args={"name": external, "place": location},
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({layout}) USING orc", args={"name": managed})
        spark.sql("REFRESH TABLE IDENTIFIER(:name)", args={"name": external})
        columns = ", ".join(schemas.names(layout))
        spark.sql(
            f"INSERT OVERWRITE IDENTIFIER(:managed) BY NAME SELECT {columns} FROM IDENTIFIER(:external)",
            args={"managed": managed, "external": external},
        )


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_days(store: Store, dataset: str, database: str, prefix: str, layout: str = schemas.MATCHED, table: str = "daily_observations") -> list[str]:
    """Register a dataset of a store as an external table by service date and part, and reload the dates that have
    changed of its managed ORC copy; returns these dates.

    The partitions of the external table are the folders that were published last. A date whose folders are not the ones
    the manifest names now is rewritten, all others are left as they are. The external table is brought up to date after
    the copy, so a run that fails in between is made up for by the next one. Every row must have a date.
    """
    spark, manifest = store.spark, store.manifest()
    external, managed = external_table(database, prefix, table), managed_table(database, prefix, table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({layout}, {DATE} string, part string) USING parquet "
        f"PARTITIONED BY ({DATE}, part) LOCATION :place",
        args={"name": external, "place": f"{store.root}/{dataset}"},
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({layout}, {DATE} string) USING orc "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({DATE})",
        args={"name": managed},
    )
    spec = lambda part: f"{DATE}={part.date}/part={part.name}"
    wanted = {spec(part): part for part in manifest.of(dataset)}
    known = {row.partition for row in spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": external}).collect()}
    new, gone = wanted.keys() - known, known - wanted.keys()
    touched = sorted({name.split("/")[0].split("=", 1)[1] for name in new | gone})
    if not touched:
        return []
    rows = store.read(dataset, layout, [part for part in wanted.values() if part.date in touched])
    # The table's own option makes an overwrite replace the dates that occur in the rows, and no other.
    rows.select(*schemas.names(layout), DATE).hint("rebalance", DATE).write.mode("overwrite").insertInto(managed)
    key = lambda name: ", ".join(f"{k}={_text(v)}" for k, v in (x.split("=", 1) for x in name.split("/")))
    if new:
        places = " ".join(f"PARTITION ({key(name)}) LOCATION {_text(f'{store.root}/{wanted[name].folder}')}" for name in sorted(new))
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS {places}", args={"name": external})
    if gone:
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS {', '.join(f'PARTITION ({key(name)})' for name in sorted(gone))}", args={"name": external})
    return touched


def rank_lines(spark: SparkSession, database: str, prefix: str) -> DataFrame:
    """Ten most disrupted lines of the managed table."""
    return spark.sql(
        """
        SELECT line_code, route_short_name, disruption_rate_pct, avg_delay_minutes
        FROM IDENTIFIER(:name)
        ORDER BY disruption_rate_pct DESC NULLS LAST, avg_delay_minutes DESC NULLS LAST,
                 line_code NULLS FIRST, route_short_name NULLS FIRST
        LIMIT 10
        """,
        args={"name": managed_table(database, prefix, "line_performance")},
    )


def rank_stops(spark: SparkSession, database: str, prefix: str) -> DataFrame:
    """Ten most disrupted stops of the managed table."""
    return spark.sql(
        """
        SELECT stop_point_name, disruption_rate_pct, avg_delay_minutes
        FROM IDENTIFIER(:name)
        ORDER BY disruption_rate_pct DESC NULLS LAST, avg_delay_minutes DESC NULLS LAST,
                 stop_point_name NULLS FIRST
        LIMIT 10
        """,
        args={"name": managed_table(database, prefix, "stop_performance")},
    )


def list_reasons(spark: SparkSession, database: str, prefix: str) -> DataFrame:
    """All reasons of the managed table, most frequent first."""
    return spark.sql(
        """
        SELECT disruption_reason, events
        FROM IDENTIFIER(:name)
        ORDER BY events DESC NULLS LAST, disruption_reason NULLS FIRST
        """,
        args={"name": managed_table(database, prefix, "disruption_reasons")},
    )

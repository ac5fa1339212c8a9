"""Writers. Unlike operators, these run jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Field texts are kept as they are: by default the writer trims them.
EXACT_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def write_parquet(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a Parquet dataset and return how many rows were written, counted by the write itself.

    With partition columns only the partitions that occur in ``rows`` are replaced. Rows are then rebalanced by
    these columns first: otherwise every task would write a small file for every partition. Adaptive execution gives
    a partition that holds much of the data to several tasks.
    """
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    written = Observation()
    observed = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return written.get["rows"]


def write_csv(rows: DataFrame, path: str) -> None:
    """Replace a CSV dataset with header, written in parallel."""
    rows.write.mode("overwrite").options(header=True, **EXACT_TEXT).csv(path)


def export_report(rows: DataFrame, path: str) -> None:
    """Write a top-k report as one CSV file with header in folder ``path``; without rows the file is empty.

    For frames that are limited already: all their rows go through one task.
    """
    found = Observation()
    report = rows.observe(found, F.count(F.lit(1)).alias("rows")).coalesce(1)
    report.write.mode("overwrite").options(header=True, **EXACT_TEXT).csv(path)
    if found.get["rows"] == 0:
        nothing = rows.sparkSession.createDataFrame([], rows.schema).coalesce(1)
        nothing.write.mode("overwrite").options(header=False, **EXACT_TEXT).csv(path)


def clean_csv(spark: SparkSession, source: str, target: str, multi_line: bool = True) -> None:
    """Copy a CSV dataset with trimmed header names and without rows that have no value at all.

    A line break inside quotes belongs to its field. For that a file is read by one task; files of a feed are few and
    bounded, and ``multi_line=False`` spreads a larger one that has no such line breaks.
    """
    raw = spark.read.options(header=True, escape='"', multiLine=multi_line).csv(source)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    # A quoted empty field is read as an empty text, and is no value either.
    fields = {c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in named.columns}
    some_value = F.coalesce(*fields.values()).isNotNull()
    write_csv(named.filter(some_value).select([field.alias(c) for c, field in fields.items()]), target)


def clean_feed(spark: SparkSession, files: dict[str, str]) -> dict[str, str | None]:
    """:func:`clean_csv` for each source → target pair. One file that fails does not stop the others; the result
    gives the error text per source, or None."""
    outcome: dict[str, str | None] = {}
    for source, target in files.items():
        try:
            clean_csv(spark, source, target)
            outcome[source] = None
        except Exception as error:  # whatever a file does, the next one gets its turn
            outcome[source] = str(error)
    return outcome

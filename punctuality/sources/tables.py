"""Columnar and CSV tables."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession

from punctuality.schemas import FEED_COLUMNS


def keep_present(table: DataFrame, wanted: Sequence[str], required: Collection[str] = ()) -> DataFrame:
    """The wanted columns that the table has, in the wanted order. A required one that is missing is an error."""
    missing = [c for c in required if c not in table.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}; present: {', '.join(table.columns)}")
    return table.select([c for c in wanted if c in table.columns])


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with a header row; every column is text, and columns go by name, not by position.

    A quote inside a quoted field is doubled. A line break inside quotes ends the row unless ``multiLine`` is given,
    with which a file is read by one task.
    """
    return spark.read.options(header=True, **{"escape": '"', **options}).csv(path)


def read_feed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four feed tables of a folder, each cut to the columns in use."""
    return {
        name: keep_present(read_csv(spark, f"{folder}/{name}.txt"), columns, required=columns)
        for name, columns in FEED_COLUMNS.items()
    }


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

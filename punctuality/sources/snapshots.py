"""Snapshot documents: one JSON document per file, read as a whole text so that what cannot be parsed is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from punctuality.operators.documents import examine
from punctuality.schemas import COLLECTION_REPORT

# Snapshot and report files share a folder and are told apart by name.
SNAPSHOT_FILES = "snapshot_*.json"
REPORT_FILES = "collection_report_*.json"

#: Spark looks up the files of a micro-batch again in a job with a task for each file, twice a batch, up to the number in
#: this setting. A file is looked up in far less time than a task takes.
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64


def _follow(spark: SparkSession, pattern: str, files_per_batch: int | None) -> DataStreamReader:
    if int(spark.conf.get(LISTING)) > LISTING_TASKS:
        spark.conf.set(LISTING, str(LISTING_TASKS))
    reader = spark.readStream.option("pathGlobFilter", pattern)
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def _named(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("value").alias("document"),
    )


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshot files of a folder, one row each: base name, size, time and text."""
    return _named(spark.read.option("pathGlobFilter", SNAPSHOT_FILES).text(folder, wholetext=True))


def follow_texts(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming version of :func:`read_texts`: each file is delivered once, whole, in one micro-batch."""
    return _named(_follow(spark, SNAPSHOT_FILES, files_per_batch).text(folder, wholetext=True))


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshot documents of a folder with the base name of their file and what they turned out to be."""
    return examine(read_texts(spark, folder)).select("source_file", "status", "Siri")


def follow_reports(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming version of :func:`read_collection_reports`: each file is delivered once, whole, in one micro-batch."""
    reader = _follow(spark, REPORT_FILES, files_per_batch).schema(StructType.fromDDL(COLLECTION_REPORT))
    return reader.option("multiLine", True).json(folder)


def read_collection_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the collector's report files; each file is a JSON list, which gives one row per entry."""
    reader = spark.read.schema(StructType.fromDDL(COLLECTION_REPORT))
    return reader.options(multiLine=True, pathGlobFilter=REPORT_FILES).json(folder)

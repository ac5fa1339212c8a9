"""The corpus pipeline: quality rules, near duplicates, substring duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; all but the last return the columns of
``docs``, whatever they are. Near duplicates are judged on five-word shingles at a similarity of 0.8.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctuality.llm import minhash, packing, pii, quality, substring
from punctuality.llm.common import scratch_folder, stored
from punctuality.llm.queries import vocabulary

#: SQL cannot express stages 2 to 5 (MinHash components, boosted trees, tokens); they are tested against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, then documents that lose too much.

    Null and empty texts have no words and go. Rows are judged one by one, so repeated rows share their fate; other columns
    stay as they are, and an empty table gives an empty one. No order is needed, so there are no ties.
    """
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, null ids last.

    A document is an id and a text, so texts under one id are told apart and each is judged by itself; of rows with equal id
    and text the first by its other columns stays. Documents without words are in no group. Ids may be of any type.
    """
    identity = F.xxhash64("doc_id", "text")
    found = stored(minhash.near_duplicates(docs.select(identity.alias("doc_id"), "text")), "judged")
    groups = found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).distinct()
    named = docs.select(F.col("doc_id").alias("id"), identity.alias("key")).join(groups, "key")
    order = F.struct(F.col("id").isNull(), "id", "key")
    chosen = stored(named.groupBy("group").agg(F.min_by("key", order).alias("__key")), "chosen")
    rows = docs.withColumn("__key", identity)
    repeated = named.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("__key"))
    kept = rows.join(chosen.select("__key"), "__key", "left_semi")
    once, more = kept.join(repeated, "__key", "left_anti"), kept.join(repeated, "__key", "left_semi")
    place = F.row_number().over(Window.partitionBy("__key", "doc_id", "text").orderBy(*[F.col(f"`{c}`").cast("string") for c in docs.columns]))
    first = more.withColumn("__place", place).filter("__place = 1").drop("__place")
    return once.unionByName(first).select(*docs.columns)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document without such words keeps its text as it is.

    A passage that repeats goes wherever it stands, the first place included, so ties do not arise; rows that repeat as a
    whole lose all words of windows they share. Null stays null, other columns stay, and an empty table gives an empty one.
    """
    return substring.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span is replaced by the name of its kind.

    Of overlapping spans base patterns come first, then the highest score, then the earliest and longest. Null stays null,
    repeated rows are treated alike, other columns stay; an empty table gives an empty one, found by the trees of no sample.
    """
    return pii.redact(docs, pii.fitted(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in a sequence.

    Null and empty texts are the end token alone. Each row is cut by itself, so repeated rows and null ids give pieces of their
    own; pieces of one length are interchangeable. Columns other than id and text are not read; an empty table gives no rows.
    """
    placed = packing.pack(packing.cut(docs, vocabulary()))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_duplicates", substring_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/llm-pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

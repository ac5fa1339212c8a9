"""A fresh folder for intermediate files that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``."""
    named = spark.conf.get(SETTING, None)
    if not named:
        raise ValueError(f"set {SETTING} to a folder that all executors reach")
    return named.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder that nothing else uses; it is created by whoever writes to it, and whoever owns the shared
    folder clears it."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

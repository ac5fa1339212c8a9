"""Files of the store that Spark reads, by way of its own file systems: small texts, listings, removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, place = _place(spark, folder)
    return sorted(found.getPath().getName() for found in system.listStatus(place)) if system.exists(place) else []


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; False if it is there already."""
    system, place = _place(spark, path)
    _, partial = _place(spark, f"{path.rsplit('/', 1)[0]}/_{path.rsplit('/', 1)[1]}")
    system.mkdirs(place.getParent())
    out = system.create(partial, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    # The local file system renames over what is there, others refuse; so look first, and trust the answer as well.
    return not system.exists(place) and system.rename(partial, place)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, place = _place(spark, path)
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it is not there."""
    system, place = _place(spark, path)
    system.delete(place, True)

"""What the corpus operators share: words, scratch tables in the shared folder, slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Characters that part words in every operator of this package: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: Text handled at once inside a task.
SLICE_BYTES = 8 << 20


def scratch_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; every executor reaches it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return named.rstrip("/")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back: no lineage, and nothing is computed twice.

    Whoever owns the shared folder removes these ``llm-*`` tables after the job.
    """
    spark = rows.sparkSession
    path = f"{scratch_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def stored_count(rows: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """:func:`stored`, and the number of rows as the write itself counted it."""
    seen = Observation()
    kept = stored(rows.observe(seen, F.count(F.lit(1)).alias("n")), purpose)
    return kept, seen.get["n"]


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text; one longer text makes a slice of its own."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.binary())
        start = total = 0
        for row in range(batch.num_rows):
            size = len(sizes[row].as_buffer()) if sizes[row].is_valid else 0
            if row > start and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)


def split_words(part: pa.RecordBatch, column: int = 1, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a slice, the words of all its rows as numbers of those, and the words of each row.

    Words are runs of anything but ``SPACES``; ``lower`` puts A-Z in lower case, everything else stays as it is.
    """
    text = pc.fill_null(part.column(column).cast(pa.string()), "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)))
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    counts = np.diff(ends[offsets])
    coded = flat.filter(real).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), counts


def spans_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive runs of the given lengths."""
    ends = np.cumsum(counts)
    return ends - counts, ends


#: A-Z become a-z, all other ASCII but letters and digits a space: on the bytes of UTF-8 text, where others are 0x80 and up.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def plain_terms(part: pa.RecordBatch, column: int = 1) -> pa.Array:
    """The texts of a slice with A-Z in lower case and a space for every ASCII character that is no letter or digit.

    What stays between the spaces are a text's terms. Null is an empty text; each text ends in a space.
    """
    text = pc.fill_null(part.column(column).cast(pa.string()), "")
    text = pc.binary_join_element_wise(text, "", " ")  # a space after each, so that neighbours never touch
    _, offsets, data = text.buffers()
    return pa.StringArray.from_buffers(len(text), offsets, pa.py_buffer(data.to_pybytes().translate(PLAIN)), offset=text.offset)

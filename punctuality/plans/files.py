"""Files with given names, as the collector leaves them. For the test tables; the library itself only reads them."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow.fs
from pyspark.sql import DataFrame, Row


def write_files(documents: DataFrame, folder: str) -> None:
    """Write ``document`` (text) of each row to the file ``source_file`` in a folder that all executors reach.

    File names carry meaning here and Spark's own writers choose theirs, so each task writes its rows itself. A
    task that runs again writes the same files with the same content.
    """
    java = documents.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    uri = java.getFileSystem(documents.sparkSession._jsc.hadoopConfiguration()).makeQualified(java).toString()

    def write(rows: Iterable[Row]) -> None:
        target, base = pyarrow.fs.FileSystem.from_uri(uri)
        for row in rows:
            # Readers ignore names with a leading underscore, so a file is seen only when it is complete.
            partial, final = f"{base}/_{row.source_file}", f"{base}/{row.source_file}"
            with target.open_output_stream(partial) as out:
                out.write(row.document.encode("utf-8"))
            target.move(partial, final)

    target, base = pyarrow.fs.FileSystem.from_uri(uri)
    target.create_dir(base, recursive=True)
    documents.select("source_file", "document").foreachPartition(write)

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over one text column (or several, given tuples)."""

    def run(rows, names, expression):
        schema = ", ".join(f"{name} string" for name in names)
        frame = spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], schema)
        return [row[0] for row in frame.coalesce(1).select(expression).collect()]

    return run


def rows_of(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)

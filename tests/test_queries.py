"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        files = path / "*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return connection


def test_keys_agree():
    assert set(driver.QUERIES) == set(driver.ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = driver.queries()[name](spark, str(TABLES))
    result = duck.execute(driver.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(found.columns)
    got = sorted((tuple(row) for row in found.select(*columns).collect()), key=repr)
    expected = sorted(result.fetchall(), key=repr)
    assert got == expected and got


def test_entry(spark):
    assert driver.entry(spark).columns[0] == "line_code"

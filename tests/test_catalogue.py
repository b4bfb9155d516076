"""Every query against its SQL, on the smallest benchmark tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from fieldheat.plans.catalogue import QUERIES  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(str(row[n]) for n in order) for row in data)


def test_every_query_has_sql():
    """Of the catalogue; some corpus queries have none."""
    assert set(QUERIES) <= SQL.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, str(FOLDER))
    expected = duck.execute(SQL[name])
    columns = [column[0] for column in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows(found.columns, found.collect()) == rows(columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0

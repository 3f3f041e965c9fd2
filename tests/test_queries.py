"""Every registered query against its SQL on the smallest tables."""

import math
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from shelfmatch.checks.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, str(DATA))
    found = table(df.columns, df.collect())
    if name not in registered.oracle_sql():
        assert found[1]
        return
    cursor = duck.execute(registered.oracle_sql()[name])
    wanted = table([c[0] for c in cursor.description], cursor.fetchall())
    assert found == wanted


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() > 0

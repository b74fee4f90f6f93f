"""Every registered query against its SQL, on the smallest given tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from eventgauge.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def shown(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def ordered(found):
    return sorted(found, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def test_every_query_has_sql():
    names = set(registry.all_queries())
    assert names <= set(driver.queries())
    assert names <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query(spark, duck, name):
    frame = driver.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    result = duck.execute(driver.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    assert {c: TYPES[frame.schema[c].dataType.simpleString()] for c in columns} == described
    places = [list(described).index(c) for c in columns]
    expected = [tuple(shown(row[i]) for i in places) for row in result.fetchall()]
    got = [tuple(shown(row[c]) for c in columns) for row in frame.collect()]
    assert ordered(got) == ordered(expected)

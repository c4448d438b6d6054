"""Every registered query against its SQL, over whole tables."""

import datetime
import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

FOLDER = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

spec = importlib.util.spec_from_file_location("spark_entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((repr([plain(row[n]) for n in order]) for row in found))


QUERIES = entry.QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(entry.ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, str(FOLDER))
    result = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(names)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(names, result.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 50

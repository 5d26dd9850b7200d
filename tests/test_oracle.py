"""Every query with SQL agrees with DuckDB on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from presslens.plans import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    got = df.collect()
    assert got
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(df.columns)
        wanted = want.fetchall()
        assert wanted  # a query whose answer is empty shows nothing
        assert rows_of(df.columns, got) == rows_of(names, wanted)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""The registry: queries run, and agree with their SQL on the smallest tables."""

import os
from collections import Counter
from glob import glob

import duckdb
import pytest

import __spark_entry__
from framewright.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
CORE = sorted(catalogue.queries())


def plain(value):
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return tuple(map(plain, value)) if isinstance(value, list | tuple) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set memory_limit = '4GB'")
    for path in glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_registry():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalogue.queries()) <= set(__spark_entry__.queries())


def test_entry_has_rows(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and sorted(r["seat"] for r in rows) == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    rows, sql = df.collect(), catalogue.oracle_sql().get(name)
    if sql is None:
        return
    found = duck.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(plain(r[c]) for c in columns) for r in rows) == Counter(tuple(plain(v) for v in r) for r in found.fetchall())

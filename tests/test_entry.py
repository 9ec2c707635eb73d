"""Every registered query against its SQL on the smallest given tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
# The training-data operators have tests of their own.
QUERIES = {name: build for name, build in entry.queries().items() if name in entry.QUERIES}
ORACLES = entry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "~" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime.combine(value, dt.time()).isoformat()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def _sorted(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    relation = duck.sql(ORACLES[name])
    assert got == _sorted(relation.columns, relation.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0

"""Every query with SQL against DuckDB on the smallest data folder."""

import os

import duckdb
import pytest
from lexmill.plans import editions, more, ordered, stored, streams, texts  # noqa: F401
from lexmill.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    if name in ORACLES:
        r = duck.sql(ORACLES[name])
        at = [r.columns.index(c) for c in columns]
        assert rows == sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall())

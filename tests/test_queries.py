"""Every registered query against its oracle SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registered
from check import rows_of
from testbed.flat import BASE_TABLES
from testbed.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
# The whole load-and-build job is covered in test_jobs.
NAMES = [name for name in QUERIES if name != "elt_report"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() == 14610

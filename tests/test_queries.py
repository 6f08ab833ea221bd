"""Every registered query against its SQL on the smallest driver tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, key):
    df = entry.queries()[key](spark, SF)
    answer = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, answer.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

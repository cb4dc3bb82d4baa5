"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as E
from check import table


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, sf, db, name):
    df = E.queries()[name](spark, sf)
    rows = df.collect()
    got = db.execute(E.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, rows) == table(columns, got.fetchall())


def test_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "doc_id", "probabilities"]
    assert df.count() == 87

"""Every query on the smallest tables against its SQL, streams too."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of

SF_DIR = "/root/testdata/sf0.001"
CORPUS = re.compile(r"op\d+_.*|pipeline")  # the optional part has tests of its own
QUERIES = {k: v for k, v in entry_points.queries().items() if not CORPUS.fullmatch(k)}
SQL = {k: v for k, v in entry_points.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["name", "n"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    want = db.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(want.columns, want.fetchall())

"""The registered queries run, and agree with their SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidewright import catalog_queries, operation_queries

QUERIES = catalog_queries.QUERIES | operation_queries.QUERIES
ORACLES = catalog_queries.ORACLES | operation_queries.ORACLES


def test_registry():
    names = set(entry.queries())
    assert set(QUERIES) <= names and set(entry.oracle_sql()) <= names


def test_flagship(spark, sf_dir):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    plain = lambda v: float(v) if type(v).__name__ == "Decimal" else v
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    cur = con.execute(ORACLES[name])
    said = [d[0] for d in cur.description]
    assert sorted(said) == columns
    assert got == sorted((tuple(plain(r[said.index(c)]) for c in columns) for r in cur.fetchall()), key=str)

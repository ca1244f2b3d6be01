"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest
from conftest import FOLDER

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    table = df.toArrow()
    got = sorted(zip(*[map(norm, table.column(c).to_pylist()) for c in cols]))
    rel = duck.sql(ORACLES[name])
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {f.name: KIND[f.dataType.simpleString()] for f in df.schema} == kinds
    index = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in index) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0

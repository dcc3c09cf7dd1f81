"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from logsieve.plans.oracle import all_sql
from logsieve.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    assert {t for _, t in df.dtypes} <= {"bigint", "double", "string"}
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=_sort_key)
    relation = oracle.sql(SQL[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    spark_kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    assert {c: spark_kinds[t] for c, t in df.dtypes} == kinds
    order = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=_sort_key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert a == b, (g, w)


def test_all_are_registered():
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

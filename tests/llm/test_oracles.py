"""Queries that SQL can express, against their SQL on whole tables."""

import glob
import os

import duckdb
import pytest

from logsieve.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    relation = db.sql(ORACLE_SQL[name])
    columns = sorted(relation.columns)
    want = sorted((tuple(r[relation.columns.index(c)] for c in columns) for r in relation.fetchall()), key=str)
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

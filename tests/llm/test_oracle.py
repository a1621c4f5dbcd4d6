"""Queries with SQL against it, on the same tables."""

import os

import duckdb
import pytest

from hourmill.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("HOURMILL_LLM_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings conversations".split()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result, twin = QUERIES[name](spark, SF_DIR), duck.sql(SQL[name])
    assert sorted(result.columns) == sorted(twin.columns)
    order = sorted(range(len(twin.columns)), key=lambda i: twin.columns[i])
    want = sorted((tuple(r[i] for i in order) for r in twin.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in sorted(result.columns)) for r in result.collect()), key=repr)
    if name == "op8_nearest":  # distances may differ in the last bits
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a == pytest.approx(b, rel=1e-12)
    else:
        assert got == want and got

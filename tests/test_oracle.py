"""Every registered query against its SQL twin on the same tables."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.catalogue import QUERIES
from checks.oracle import statements

SF_DIR = os.environ.get("HOURMILL_SF_DIR", "/root/testdata/sf0.01")
TABLES = "orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_keys_match():
    assert QUERIES.keys() == statements().keys()
    assert QUERIES.keys() <= contract.queries().keys() and statements().items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    twin = duck.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(twin.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP"}
    ours = {c: kinds.get(t, t.upper()) for c, t in result.dtypes}
    theirs = {c: str(t) for c, t in zip(twin.columns, twin.types)}
    assert ours == theirs
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(twin.columns, twin.fetchall())
    assert len(got) == len(want) and len(got) > 0
    assert got == want

"""Operators that SQL can express, against that SQL."""

import os

import duckdb
import pytest

from tidemark.llm import expected
from tidemark.llm.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(expected.SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = all_queries()[name](spark, SF_DIR)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = db.sql(f"SELECT {columns} FROM ({expected.SQL[name]})")
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert [kinds[t] for _, t in got.dtypes] == [str(t) for t in want.types]
    key = lambda row: tuple(map(repr, row))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)

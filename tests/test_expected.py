"""Every registered query against its SQL, both run on the same Parquet tables."""

import math
import os

import duckdb
import pytest

from tidemark.plans import expected
from tidemark.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


# Spark type names and their counterparts.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def _type(field):
    name = field.dataType.simpleString()
    return TYPES.get(name, name.upper())


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted(rows):
    return sorted((tuple(map(_plain, r)) for r in rows), key=lambda r: tuple(map(repr, r)))


def test_every_query_has_sql():
    assert set(all_queries()) == set(expected.SQL)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, db, name):
    got = all_queries()[name](spark, SF_DIR)
    want = db.sql(expected.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    stated_types = dict(zip(want.columns, map(str, want.types)))
    assert {f.name: _type(f) for f in got.schema} == stated_types
    found = _sorted(got.select(*[got[c] for c in columns]).collect())
    chosen = ", ".join(f'"{c}"' for c in columns)
    stated = _sorted(db.sql(f"SELECT {chosen} FROM ({expected.SQL[name]})").fetchall())
    assert stated, "the query should have rows"
    assert found == stated

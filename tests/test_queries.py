"""Every registered query against its SQL counterpart."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from logquarry.plans.oracles import ORACLES
from logquarry.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

# What the engines call the same type.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events",):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    assert {c: SAME_TYPE[t] for c, t in got.dtypes} == types
    rows = [tuple(r) for r in got.collect()]
    assert rows
    assert len(rows) == len(want)
    assert _rows(got.columns, rows) == _rows(list(types), want)

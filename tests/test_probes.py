"""Every registered query against its SQL on DuckDB."""

import math
import os

import duckdb
import pytest

from conftest import SF_DIR

from feedlake.plans.oracles import ORACLES
from feedlake.plans.probes import PROBES as QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    want = ordered(columns, expected.fetchall())
    have = ordered(got.columns, got.collect())
    assert len(have) == len(want)
    assert have == want

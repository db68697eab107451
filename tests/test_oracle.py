"""Every registered query against its SQL on the smallest given tables."""

import math
import os

import duckdb
import pytest

from funnelwright.queries import oracles, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(FOLDER))] if os.path.isdir(FOLDER) else []


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return None if value is None else f"{type(value).__name__} {value}"


@pytest.mark.skipif(not TABLES, reason="given tables not present")
@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_oracle(spark, oracle, name):
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = oracle.execute(oracles()[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    positions = [named.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in positions) for r in cursor.fetchall()), key=repr)
    actual = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert actual == expected


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracles())

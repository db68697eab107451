"""The subpackage's queries on the smallest given tables, against SQL where there is some."""

import os

import duckdb
import pytest

from funnelwright.llm.registered import oracles, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f.removesuffix(".parquet") for f in sorted(os.listdir(FOLDER))] if os.path.isdir(FOLDER) else []


@pytest.mark.skipif(not TABLES, reason="given tables not present")
@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_oracle(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries()[name](spark, FOLDER)
    cursor = connection.execute(oracles()[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == sorted(df.columns)
    places = [named.index(c) for c in df.columns]
    expected = sorted((tuple(r[i] for i in places) for r in cursor.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == expected


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 14))

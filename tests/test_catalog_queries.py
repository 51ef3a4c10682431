"""Every registered query against its SQL in DuckDB, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from tessera.plans.feature_queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return float(value) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    at = [list(want.columns).index(c) for c in columns]
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert ours == theirs

"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from tabular_spark.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def rows(values):
    def plain(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return ""
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(map(plain, v)) for v in values)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    found = duck.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in found.fetchall()]
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want)

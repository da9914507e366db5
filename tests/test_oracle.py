"""Every registered query with SQL equals that SQL in DuckDB, on whole tables."""

import math

import duckdb
import pandas as pd
import pytest
from conftest import DATA

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if pd.isna(value):
        return ""
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return str(value)


def rows(frame, columns):
    return sorted(tuple(plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


def close(a, b):
    try:
        return math.isclose(float(a), float(b), abs_tol=1.1e-4)
    except ValueError:
        return a == b


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, DATA)
    ours, theirs = result.toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    columns = sorted(result.columns)
    assert columns == sorted(theirs.columns)
    left, right = rows(ours, columns), rows(theirs, columns)
    assert len(left) == len(right) > 0
    different = [(a, b) for a, b in zip(left, right) if a != b]
    assert all(all(close(x, y) for x, y in zip(a, b)) for a, b in different), different[:3]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 2_500

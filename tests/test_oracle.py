"""Every registered query against DuckDB: same columns, types and rows, in any order."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from clickmill.plans.oracle import ORACLE_SQL
from clickmill.plans.queries import QUERIES

TABLES = ["events", "part"]


def connect(pattern):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{pattern.format(name)}'")
    return connection


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir + "/{}.parquet")


@pytest.fixture(scope="module")
def skewed_duck(skewed_dir):
    return connect(skewed_dir + "/{}.parquet/*.parquet")


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= queries().items() and ORACLE_SQL.items() <= oracle_sql().items()
    assert not set(oracle_sql()) - set(queries())


def assert_same(spark, path, duck, name):
    ours = normalised(QUERIES[name](spark, path).toPandas())
    theirs = normalised(duck.sql(ORACLE_SQL[name]).df())
    assert len(theirs) > 0
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, sf_dir, duck, name):
    assert_same(spark, sf_dir, duck, name)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle_on_skewed_directories(spark, skewed_dir, skewed_duck, name):
    assert_same(spark, skewed_dir, skewed_duck, name)


def test_entry(spark):
    assert entry(spark).columns == [
        "product", "timestamp_hour", "purchase_count", "add_to_cart_count", "page_view_count",
    ]

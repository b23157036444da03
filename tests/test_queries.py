"""Every registered query against DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import normal

pytestmark = pytest.mark.skipif(not TESTDATA.is_dir(), reason="no generated tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, db, name):
    got = queries()[name](spark, str(TESTDATA))
    want = db.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got.columns, got.collect()) == normal(want.columns, want.fetchall())


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

"""Every query with oracle SQL must equal DuckDB on the smoke tables
(columns by name, row count, order-insensitive values)."""

import pytest

import __spark_entry__ as entry
from conftest import SMOKE
from oracle_check import compare, duck

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    ok, msg, _, _ = compare(spark, con, name, entry.queries()[name], ORACLE[name], SMOKE)
    assert ok, msg


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"split", "documents", "characters", "avg_doc_length"}

"""Every query with an SQL form equals its DuckDB oracle on the small tables."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from tests.oracle_check import compare, duck

import __spark_entry__ as entry

SQL_QUERIES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert r["status"] == "match", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns[0] == "default_next_4_weeks"

"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from compare import difference, duckdb_on
from conftest import SMALL

def own(found):
    """Without the corpus operators, which have tests of their own."""
    return {name: x for name, x in found.items() if not re.match(r"op\d+_|pipeline$", name)}


ORACLE = own(driver.oracle_sql())
QUERIES = own(driver.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_on(SMALL)


def test_each_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert {"session_key", "event_order", "hr_division"} <= set(df.columns)
    assert df.count() == 1000

"""Every registered query against its DuckDB statement."""

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from anonkit.plans.registry import QUERIES

# the llm subpackage has tests of its own
ALL = {name: query for name, query in queries().items() if name in QUERIES}
SQL = {name: sql for name, sql in oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(SQL) == set(ALL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_statement(name, spark, sf_dir, duck):
    assert differences(ALL[name](spark, sf_dir), duck, SQL[name]) == []


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 8 and set(rows[0].asDict()) == {"product_category", "revenue"}

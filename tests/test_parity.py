"""Every registered query against its check statement, on the small data set."""

import pytest
from parity import compare, connect

from oracle.statements import all_statements
from ventaria.plans.registry import all_queries

QUERIES, SQL = all_queries(), all_statements()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, small, duck):
    assert compare(QUERIES[name](spark, small), duck, SQL[name]) == ""

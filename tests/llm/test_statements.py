"""Queries of the subpackage that SQL can express, on the small data set."""

import pytest
from parity import compare, connect

from ventaria.llm.queries import QUERIES, STATEMENTS


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(name, spark, small):
    assert compare(QUERIES[name](spark, small), connect(small), STATEMENTS[name]) == ""

"""Queries with SQL against that SQL on the smallest tables."""

import pytest
from compare import DATA, compare, sql_connection

from tallyframe.llm.checks import CHECKS
from tallyframe.llm.queries import QUERIES

FOLDER = str(DATA / "sf0.001")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), sql_connection(FOLDER), CHECKS[name]) == []

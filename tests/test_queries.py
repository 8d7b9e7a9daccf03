"""Every registered query against its SQL check on the smallest tables."""

import pytest
from compare import DATA, compare, sql_connection

import __spark_entry__ as entry_points
from tallyframe.checks.queries import CHECKS
from tallyframe.plans.registry import QUERIES

FOLDER = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return sql_connection(FOLDER)


def test_same_names():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_points.queries()) and set(CHECKS) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(entry_points.queries()[name](spark, FOLDER), con, entry_points.oracle_sql()[name]) == []

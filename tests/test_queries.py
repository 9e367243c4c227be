"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import actual, difference, expected, oracle
from support import SMALL

import __spark_entry__ as entry_point
from noteloom.plans.oracles import ORACLES
from noteloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return oracle(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    columns, rows = actual(spark, SMALL, name)
    other_columns, other_rows = expected(connection, name)
    assert columns == other_columns
    assert not difference(rows, other_rows)
    assert rows or name == "cohort_day_slice"  # that day has rows from sf0.01 on


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


def test_entry(spark):
    assert entry_point.entry(spark).count() == 45

"""Every registered query with a SQL twin, side by side on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import DATA, connect, differences

SF = f"{DATA}/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, SQL[name]) == []


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())

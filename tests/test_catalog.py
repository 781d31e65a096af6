"""Every registered query with SQL agrees with it, row for row, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from riskloom import fixed_values as fv
from tests.compare import database, differences

SQL = entry.oracle_sql()
ROWS_ONLY = [name for name in entry.queries() if name not in SQL]


@pytest.fixture(scope="module", autouse=True)
def fewer_trees():
    """The queries train in full; here fewer trees keep the run short."""
    full = dict(fv.BOOSTING)
    fv.BOOSTING.update(rounds=30, depth=4)
    yield
    fv.BOOSTING.update(full)


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", list(SQL))
def test_agrees_with_sql(spark, sf, con, name):
    assert differences(entry.queries()[name](spark, sf), con, SQL[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "customer_id" and df.count() > 0

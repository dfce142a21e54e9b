"""Every registered query equals its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from clickloom.plans.registered import ORACLES as SQL, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


# The small tables hold no row for these; the larger scale does.
MAY_BE_EMPTY = set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    text = differences(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert text in ("", "EMPTY") if name in MAY_BE_EMPTY else text == "", text


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1

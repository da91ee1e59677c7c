"""Every query with SQL, compared row by row on the given tables."""

import pytest

import check
from riskloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, sf, name):
    verdict, _ = check.compare(spark, con, QUERIES[name], ORACLES[name], sf)
    assert verdict == "same"


def test_entry_points(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

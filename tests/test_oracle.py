"""Every registered query against its SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry_points
from sheafline.plans import catalog
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, folder, name):
    fn = catalog.queries()[name]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, folder).count() > 0
    else:
        assert compare(spark, con, folder, fn, sql) is None


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())

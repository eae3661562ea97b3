"""Every registered query at the smallest scale: against its SQL, or non-empty."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_point
from tallyforge.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql])
def test_equals_sql(spark, con, name):
    assert compare(spark, name, CATALOG[name], SF, con) is None


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if not q.sql])
def test_has_rows(spark, name):
    assert CATALOG[name](spark, SF).limit(1).count() == 1


def test_entry_point(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())

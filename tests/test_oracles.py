"""Every named query against its SQL twin, on whole tables."""

import pytest

from eventloom.plans.catalog import ORACLES, QUERIES

from .compare import difference, duck


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    assert difference(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["uei", "location", "events", "with_node"]
    assert out.count() > 0

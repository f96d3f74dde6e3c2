"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from lectern import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.difference(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["question_id", "prompt"] and rows.count() > 0

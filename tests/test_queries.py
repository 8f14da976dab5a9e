"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from tools import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, tables, name):
    assert compare.compare(spark, tables, SF, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

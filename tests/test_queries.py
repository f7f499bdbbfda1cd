"""Every query against its SQL, whole results, names and types."""

import pytest
from conftest import SF

import __spark_entry__ as entry
from checks.compare import compare
from checks.queries import QUERIES


def test_each_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 26 and df.count() > 0

"""Every registered query against its SQL, on the smallest given tables."""

import __spark_entry__ as entry
import compare
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF_DIR)


def test_names_match():
    assert set(entry._QUERIES) == set(entry.oracle.statements())
    assert set(entry._QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["zone_name", "zone_type", "building_name", "access_count"]


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_query(spark, database, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(result, database, entry.oracle_sql()[name]) is None

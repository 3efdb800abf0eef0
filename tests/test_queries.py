import pytest

from suite import check
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert check.compare(spark, SF, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    # Queries of the suite all have SQL; others may be tested against brute force instead.
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())

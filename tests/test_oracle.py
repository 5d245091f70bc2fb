"""Every query gives what DuckDB computes from its SQL."""

import __spark_entry__ as entry
import oracle
import pytest
import queries
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracle.ORACLE)
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    assert differences(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["stream", "message"]

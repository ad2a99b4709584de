"""Every registered query against its SQL twin."""

import pytest

from checks.compare import connect, differences
from checks.oracle import ORACLE_SQL
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def database(small):
    return connect(small)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, database, name):
    assert differences(QUERIES[name](spark, small), database, ORACLE_SQL[name]) == []


def test_smoke_entry(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert [row["rank"] for row in rows] == [1, 2, 3, 4, 5]

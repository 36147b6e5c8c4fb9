"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, oracle_connection

SMALL = "/root/testdata/sf0.001"
# Queries whose result is legitimately empty on the smallest tables.
EMPTY = {"zone_assign"}


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    verdict, detail = compare(spark, connection, name, queries()[name], oracle_sql()[name], SMALL)
    if name in EMPTY and detail == "no rows":
        return
    assert verdict == "EXACT", detail


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

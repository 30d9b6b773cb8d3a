"""Every registered query against its independent SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = entry.registered()
SQL = {name: oracle.sql(name) for name in oracle.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    out = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert out in ("", "(empty)"), out


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Each checked query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
from millrace.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_equals_sql(spark, connection, name):
    assert oracle.compare(QUERIES[name].run(spark, SF), connection, QUERIES[name].sql) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

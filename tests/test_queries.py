"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from pagemill.plans.oracle import oracle
from pagemill.plans.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert QUERIES.keys() == oracle().keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["page_id", "url", "text"] and rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    _, problem = compare(spark, connect(SF), SF, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None, problem

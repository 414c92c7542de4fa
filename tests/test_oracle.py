"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from workloads.compare import compare, connect
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ok, note, _ = compare(spark, duck, name, SMALL)
    assert ok, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:2] == ["year_month", "department"]
    assert frame.count() > 0

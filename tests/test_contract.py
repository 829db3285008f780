"""Every query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
import compare
from ledgerbrook.plans import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = compare.connect(SF)
    yield connection
    connection.close()


def test_every_query_has_sql():
    """Those of the library itself all have; optional ones may be beyond SQL."""
    assert set(queries.registered()) == set(oracles.registered())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    assert compare.differences(result, duck, contract.oracle_sql()[name]) == []


def test_entry_counts(spark):
    """Expected numbers computed apart from both sides."""
    counts = {r["status"]: r["count"] for r in contract.entry(spark).groupBy("status").count().collect()}
    assert counts == {"CANCELLED": 68, "CONFIRMED": 46, "PAYMENT_PENDING": 35}

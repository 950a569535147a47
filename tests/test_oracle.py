"""Every registered query gives what its SQL gives."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from workload.registry import QUERIES as WORKLOAD

#: The library's own queries; those of an optional subpackage have tests beside it.
QUERIES, ORACLES = WORKLOAD, {n: sql for n, sql in entry.oracle_sql().items() if n in WORKLOAD}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["External_Id", "Quantity", "Origin", "Supplier_Hash", "Label"]
    assert df.count() > 0

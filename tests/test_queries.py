"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import check, connect
from workload.queries import REGISTRY


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns[:2] == ["file_label", "group_name"]


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, sf, con, name):
    problem, rows = check(spark, sf, name, con)
    assert problem is None and rows > 0

"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    problem = compare(name, frame, duck.sql(contract.oracle_sql()[name]))
    spark.catalog.clearCache()
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_without_sql_returns_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0
    spark.catalog.clearCache()


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["id", "description", "user_name", "status", "rating", "text", "max_rating"]
    assert frame.count() > 0

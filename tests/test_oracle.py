"""Every query with a SQL counterpart must return the same rows as that SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from cartloom.checks.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.ORACLE))
def test_matches_sql(spark, connection, name):
    result = contract.queries()[name](spark, FOLDER)
    assert compare(result, connection, contract.ORACLE[name]) is None


@pytest.mark.parametrize("name", ["kmeans_sweep", "user_segments", "reorder_lr"])
def test_runs(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "order_number", "total_orders", "avg_basket_size", "reorder_rate",
    ]

"""One user, one order and one part hold a third of all rows; results must stay whole."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cartloom.checks.compare import compare, connect
from cartloom.sources.shop import shop_tables

SOURCE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="no test data")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import duckdb

    target = tmp_path_factory.mktemp("skewed")
    changed = {
        "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey",
        "lineitem": "CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN l_suppkey % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey",
    }
    for name in ("orders", "lineitem", "part"):
        columns = f"* REPLACE ({changed[name]})" if name in changed else "*"
        duckdb.sql(f"SELECT {columns} FROM '{SOURCE}/{name}.parquet'").write_parquet(
            str(target / f"{name}.parquet")
        )
    return str(target)


@pytest.mark.parametrize(
    "name",
    [
        "customer_journey", "product_segments", "product_pair_base_top20", "top_pairs",
        "potential_core_pairs", "department_matrix", "user_features", "train_dataset",
    ],
)
def test_matches_sql(spark, folder, name):
    result = contract.queries()[name](spark, folder)
    assert compare(result, connect(folder), contract.ORACLE[name]) is None


@pytest.mark.parametrize("name", ["product_pairs", "potential_core_pairs", "top_pairs"])
def test_matches_sql_in_blocks(spark, folder, name, monkeypatch):
    """The same pairs when the large order has to be cut into blocks."""
    from cartloom.operators import pairs

    for function in (pairs.pair_counts, pairs.cross_pair_counts, pairs.top_pair_counts):
        *others, _ = function.__defaults__
        monkeypatch.setattr(function, "__defaults__", (*others, 16))
    assert shop_tables(spark, folder).largest_basket() > 16
    result = contract.queries()[name](spark, folder)
    assert compare(result, connect(folder), contract.ORACLE[name]) is None


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.ORACLE) - {"auc_roc_score"}))
def test_no_query_crosses_relations(spark, folder, name):
    plan = plan_of(contract.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(contract.queries()["top_first_in_cart"](spark, folder))
    assert "PushedFilters: [IsNotNull(add_to_cart_order), EqualTo(add_to_cart_order,1)" in plan
    lines = [line for line in plan.splitlines() if ".lines[" in line]
    assert lines and "reordered" not in lines[0]


def test_prior_lines_are_read_from_their_partition(spark, folder):
    t = shop_tables(spark, folder)
    plan = plan_of(t.op_prior.agg(F.count(F.lit(1))))
    assert "PartitionFilters: [isnotnull(eval_set" in plan

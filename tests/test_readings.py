"""How often the plans that ran read the order lines."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.mark.parametrize(
    "name, most",
    [
        ("product_segments", 0), ("top_pairs", 2), ("product_pair_base_top20", 2), ("product_pair_base", 1),
        ("potential_core_pairs", 1), ("top_potential_products", 2), ("department_matrix", 1),
        ("cart_position_buckets", 1), ("named_rules", 0), ("cluster_profiles", 0),
    ],
)
def test_readings_of_the_lines(spark, capsys, name, most):
    result = contract.queries()[name](spark, FOLDER)
    result.collect()
    capsys.readouterr()
    result.explain("simple")
    final, _, _ = capsys.readouterr().out.partition("== Initial Plan ==")
    assert final.count(".lines[") <= most

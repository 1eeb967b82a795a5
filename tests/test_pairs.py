from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import as_dicts, make_tables
from pyspark.sql import functions as F

from cartloom.operators.pairs import (
    _large_orders, _unfold_blocks, cross_pair_counts, pair_counts, top_pair_counts,
)
from cartloom.plans import products


def random_lines(seed: int, orders: int = 60, catalogue: int = 30) -> list[tuple[int, int]]:
    """Small orders, one order holding the whole catalogue, and repeated lines."""
    draw = random.Random(seed)
    lines = [(0, product) for product in range(catalogue)]
    for order in range(1, orders):
        for _ in range(draw.randint(1, 6)):
            lines.append((order, min(draw.randrange(catalogue), draw.randrange(catalogue))))
    return lines


def brute_force(lines) -> Counter:
    baskets: dict[int, set] = {}
    for order, product in lines:
        baskets.setdefault(order, set()).add(product)
    return Counter(
        pair for items in baskets.values() for pair in combinations(sorted(items), 2)
    )


def counted(df) -> dict:
    return {
        (r["product_a_id"], r["product_b_id"]): r["co_occurrence"] for r in as_dicts(df)
    }


@pytest.mark.parametrize("block", [4, 7, 1024])
def test_pair_counts_match_brute_force(spark, block):
    lines = random_lines(1)
    df = spark.createDataFrame(lines, "order_id bigint, product_id bigint")
    assert counted(pair_counts(df, 30, block)) == brute_force(lines)


@pytest.mark.parametrize("block", [4, 1024])
def test_cross_pairs_match_brute_force(spark, block):
    lines = random_lines(2)
    df = spark.createDataFrame(
        [(o, p, p % 3 == 0) for o, p in lines], "order_id bigint, product_id bigint, is_left boolean"
    )
    expected = Counter()
    for (a, b), n in brute_force(lines).items():
        if (a % 3 == 0) != (b % 3 == 0):
            expected[(a, b) if a % 3 == 0 else (b, a)] += n
    found = {
        (r["left_id"], r["right_id"]): r["co_occurrence"]
        for r in as_dicts(cross_pair_counts(df, 30, block))
    }
    assert found == expected


@pytest.mark.parametrize("seeds,k", [(3, 2), (5, 8), (64, 500)])
def test_top_pairs_are_exact_for_any_number_of_seeds(spark, seeds, k):
    lines = random_lines(3)
    df = spark.createDataFrame(lines, "order_id bigint, product_id bigint")
    best = sorted(brute_force(lines).items(), key=lambda item: (-item[1], item[0]))[:k]
    frequency = df.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    found = top_pair_counts(df, k, 30, lambda small: small, frequency, seeds=seeds)
    assert counted(found) == dict(best)


def test_block_plans_spread_one_order(spark):
    """All cells of one large order must not end in one task."""
    df = spark.createDataFrame([(1, n) for n in range(64)], "order_id bigint, product_id bigint")
    unfolded = _unfold_blocks(df, _large_orders(df, 4)).withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = unfolded.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 64 * 63 // 2
    assert len({row.task for row in rows}) > 1


def test_one_large_order_leaves_the_small_ones_whole(spark):
    """An order of 2,000 products among small ones: only its lines are dealt out in blocks."""
    lines = [(0, n) for n in range(2000)] + random_lines(5, orders=40)
    df = spark.createDataFrame(lines, "order_id bigint, product_id bigint")
    assert counted(pair_counts(df, 2000)) == brute_force(lines)
    large = _large_orders(df, 1024).collect()
    assert [(row.order_id, row.parts) for row in large] == [(0, 2)]


SALES = [
    # order, product, position, reordered: 10 core, 11 mainstream, 12 potential, 13 boost
    *[(o, 10, 1, 1) for o in (1, 2, 3, 5, 7)],
    *[(o, 11, 2, 0) for o in (1, 3, 5, 7)],
    *[(o, 12, 3, 1) for o in (1, 2)],
    *[(o, 13, 4, 0) for o in (3,)],
]


def test_segments_use_the_median_of_common_products_only(spark):
    t = make_tables(spark, prior=SALES, train=[])
    rows = {
        r["product_id"]: r["product_segment"]
        for r in as_dicts(products.product_segments(t, median_min_purchases=1))
    }
    # Reach medians: 1, 1, 3, 3 buyers; the lower median counts and equality is on the high side.
    assert rows == {10: "core", 11: "core", 12: "core", 13: "core"}
    rows = {
        r["product_id"]: r["product_segment"]
        for r in as_dicts(products.product_segments(t, median_min_purchases=5))
    }
    assert rows == {10: "core", 11: "mainstream", 12: "potential", 13: "boost"}


def test_floors_demote_to_boost(spark):
    t = make_tables(spark, prior=SALES, train=[])
    rows = {
        r["product_id"]: r["product_segment"]
        for r in as_dicts(
            products.product_segments(t, median_min_purchases=5, min_core=5, min_potential=1)
        )
    }
    assert rows == {10: "boost", 11: "mainstream", 12: "potential", 13: "boost"}


def test_potential_core_pairs_are_oriented(spark):
    t = make_tables(spark, prior=SALES, train=[])
    rows = as_dicts(products.potential_core_pairs(t, median_min_purchases=5))
    assert [(r["hidden_gem"][:5], r["blockbuster"], r["co_occurrence"]) for r in rows] == [
        ("Plain", "Organic Milk", 2)
    ]
    assert rows[0]["organic_pair_type"] == "Mixed Organic and Non-Organic"
    strength = as_dicts(products.pair_node_strength(products.potential_core_pairs(
        t, median_min_purchases=5)))
    assert [r["strength"] for r in strength] == [2, 2]


def test_lonely_products_are_not_potential_top_sellers(spark):
    lines = [(1, 10, 1, 1), (2, 10, 1, 1), (3, 10, 1, 1), (5, 12, 1, 1)]
    t = make_tables(spark, prior=lines, train=[])
    assert as_dicts(products.top_potential_products(t, median_min_purchases=3)) == []


def test_top_pairs_and_labels(spark):
    t = make_tables(spark, prior=SALES, train=[])
    best = products.top_pairs(t, min_purchases=1, k=2, median_min_purchases=5)
    rows = as_dicts(best)
    assert [r["co_occurrence"] for r in rows] == [4, 2]
    assert rows[0]["organic_pair_type"] == "Both Organic"
    labels = as_dicts(products.pair_labels(best, 7))
    assert labels[0] == {
        "pair_label": "Organic + ORGANIC", "pair_type": "Organic + Organic", "co_occurrence": 4,
    }


def test_pair_base_keeps_every_pair_or_the_best(spark):
    t = make_tables(spark, prior=SALES, train=[])
    everything = counted(products.product_pair_base(t))
    assert everything == brute_force([(o, p) for o, p, *_ in SALES])
    best = counted(products.product_pair_base(t, top_pairs=1))
    assert best == {(10, 11): 4}


def test_department_matrix(shop):
    rows = {r["department"]: r for r in as_dicts(products.department_matrix(shop))}
    assert rows["dairy eggs"]["total_unique_buyers"] == 2
    assert rows["dairy eggs"]["total_purchases"] == 5
    assert rows["household"]["total_products"] == 2
    assert rows["household"]["avg_items_per_order"] == 1.0
    ranked = as_dicts(products.segment_sort(products.department_matrix(shop)))
    assert ranked[0]["department_segment"] == "magnet"

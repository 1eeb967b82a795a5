from __future__ import annotations

import pytest
from conftest import AISLES, ORDERS, as_dicts, make_tables
from pyspark.sql import functions as F

from cartloom.functions.labels import position_bucket
from cartloom.operators import profile
from cartloom.plans import behaviour, exports


def test_orders_by_day_hour_counts_every_order(shop):
    rows = as_dicts(behaviour.orders_by_day_hour(shop))
    assert sum(row["total_orders"] for row in rows) == len(ORDERS)
    assert abs(sum(row["pct_of_total"] for row in rows) - 100) < 0.1
    assert rows[0]["day_name"] == "Sunday" and rows[-1]["day_name"] == "Saturday"


def test_matrix_has_a_zero_for_empty_hours(shop):
    rows = {row["order_dow"]: row for row in as_dicts(behaviour.pivot_day_hour(shop))}
    assert rows[0]["h08"] == 1 and rows[0]["h09"] == 1 and rows[0]["h23"] == 0
    assert rows[6]["h23"] == 1


def test_gaps_leave_out_first_and_same_day_orders(shop):
    gaps = {r["days_since_prior"]: r["total_orders"] for r in as_dicts(
        behaviour.order_gap_distribution(shop))}
    assert gaps == {3.0: 1, 5.0: 1, 7.0: 1, 30.0: 1}


def test_basket_sizes_cover_orders_with_lines_only(shop):
    sizes = {r["basket_size"]: r["total_orders"] for r in as_dicts(
        behaviour.basket_size_distribution(shop))}
    assert sizes == {1: 2, 2: 4, 3: 1}
    assert [r["basket_size"] for r in as_dicts(behaviour.basket_size_distribution(shop, 2))] == [1, 2]


def test_first_in_cart_breaks_ties_by_product(shop):
    rows = as_dicts(behaviour.top_first_in_cart(shop, 2))
    assert [(r["product_id"], r["first_in_cart_count"]) for r in rows] == [(10, 5), (11, 1)]


def test_journey_weighs_lines(shop):
    rows = {r["order_number"]: r for r in as_dicts(behaviour.customer_journey(shop))}
    assert rows[1] == {
        "order_number": 1, "total_orders": 3, "avg_basket_size": 2.0, "reorder_rate": 0.0,
    }
    assert rows[2]["reorder_rate"] == 66.67
    assert [r["order_number"] for r in as_dicts(behaviour.customer_journey(shop, max_order=2))] == [1, 2]


def test_flag_ignores_letter_case(shop):
    rows = {r["product_category"]: r["total_sold"] for r in as_dicts(behaviour.flag_comparison(shop))}
    assert rows == {"Organic": 8, "Non-Organic": 5}


def test_aisle_sales_of_one_department(shop):
    assert as_dicts(behaviour.aisle_sales(shop)) == [
        {"aisle": "fruit", "total_sales": 3, "reorder_rate": 33.33}
    ]


def test_first_item_lifetime(shop):
    rows = as_dicts(behaviour.first_item_lifetime(shop, min_users=1))
    assert rows == [
        {"department": "dairy eggs", "total_users": 2, "avg_lifetime_orders": 3.0}
    ]


def test_equal_cuts_leave_a_bucket_empty(spark):
    lines = [(n, 10, 1, 0) for n in range(1, 9)] + [(1, 11, 2, 0), (2, 11, 2, 1)]
    rows = as_dicts(behaviour.cart_position_buckets(make_tables(spark, prior=lines, train=[])))
    assert [(r["cart_position_bucket"], r["total_items"]) for r in rows] == [
        ("1. Very Early (<=1)", 8), ("5. Late (>1)", 2),
    ]
    assert sum(r["pct_items_share"] for r in rows) == 100


def test_department_stats_and_top_products(shop):
    stats = {r["department"]: r for r in as_dicts(exports.department_stats(shop))}
    assert stats["dairy eggs"]["total_orders"] == 4
    assert stats["dairy eggs"]["reorder_rate"] == 0.5
    top = as_dicts(exports.top_products(shop, 2))
    assert [r["product_id"] for r in top] == [10, 11]
    assert [r["is_organic"] for r in top] == [1, 1]


def test_profiles(shop):
    counts = {r["table_name"]: r for r in as_dicts(profile.table_summary(shop))}
    assert counts["orders"]["row_count"] == len(ORDERS)
    assert counts["aisles"] == {"table_name": "aisles", "row_count": len(AISLES), "column_count": 2}
    assert as_dicts(profile.null_counts(shop.orders))[0]["days_since_prior_order"] == 4
    labels = {r["reordered"]: r["pct_of_total"] for r in as_dicts(
        profile.label_distribution(shop.op_train, "reordered"))}
    assert labels == {0: 66.67, 1: 33.33}
    described = {r["summary"]: r for r in as_dicts(
        profile.describe_cols(shop.orders, ["order_number"]))}
    assert described["max"]["order_number"] == "4"


@pytest.mark.parametrize("shares", [(0.25, 0.5, 0.75), (0.1, 0.2, 0.35, 0.5, 0.7, 0.9), (0.5,)])
def test_any_number_of_position_cuts(spark, shares):
    lines = [(n, 1, 1 + n % 9_000, 0) for n in range(18_000)]
    rows = as_dicts(behaviour.cart_position_buckets(make_tables(spark, prior=lines, train=[]), shares, 4))
    assert len(rows) == len(shares) + 1 and sum(r["total_items"] for r in rows) == 18_000
    bounds = [0, *[round(share * 18_000) for share in shares], 18_000]
    assert [r["total_items"] for r in rows] == [b - a for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("shares", [(), (0.5, 0.2), (0.0, 0.5), (0.5, 0.5)])
def test_wrong_position_cuts_are_an_error(spark, shares):
    with pytest.raises(ValueError):
        behaviour.cart_position_buckets(make_tables(spark), shares)


def test_names_must_fit_the_cuts(spark):
    with pytest.raises(ValueError):
        position_bucket(F.lit(1), [F.lit(1), F.lit(2)], ("only", "two"))

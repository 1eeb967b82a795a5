from __future__ import annotations

import math

import datetime
import random

import pytest
from conftest import ORDERS, as_dicts, make_tables
from pyspark.sql import functions as F

from cartloom.operators.relational import modes_per_key
from cartloom.plans import features
from cartloom.sources import staging
from cartloom.sources.staging import store_tables


def keyed(df, *names):
    return {tuple(r[n] for n in names): r for r in as_dicts(df)}


def test_prior_full_fills_gaps_and_flags(shop):
    rows = keyed(features.prior_full(shop), "order_id", "product_id")
    assert len(rows) == 10
    assert rows[(1, 10)]["days_since_prior_order"] == 0.0
    assert rows[(1, 11)]["is_organic"] == 1 and rows[(1, 12)]["is_organic"] == 0
    assert rows[(3, 13)]["department"] == "household"


def test_user_features(shop):
    rows = keyed(features.user_features(features.prior_full(shop)), "user_id")
    first = rows[(1,)]
    assert first["u_total_orders"] == 3 and first["u_total_items"] == 7
    assert first["u_distinct_products"] == 4 and first["u_unique_aisles"] == 4
    # Gaps are weighted by lines: 0 x3, 0 x2, 7 x2.
    assert math.isclose(first["u_avg_days_since_prior"], 2.0)
    assert math.isclose(first["u_std_days_since_prior"], math.sqrt((5 * 4 + 2 * 25) / 6))
    assert math.isclose(first["u_reorder_rate"], 3 / 7)
    assert math.isclose(first["u_dairy_ratio"], 3 / 7)
    assert math.isclose(first["u_produce_ratio"], 2 / 7)
    assert first["u_preferred_dow"] == 0
    # Nine o'clock holds four lines of two orders, eight o'clock three lines of one.
    assert first["u_preferred_hour"] == 9
    assert rows[(2,)]["u_std_days_since_prior"] == 0.0
    assert (4,) not in rows


def test_mode_tie_goes_to_the_smallest_value(spark):
    df = spark.createDataFrame(
        [(1, 5, 2), (1, 3, 2), (1, 9, 1), (2, 0, 1), (2, 1023, 4)], "k int, v int, w bigint"
    )
    assert {r["k"]: r["m"] for r in as_dicts(modes_per_key(df, "k", {"m": "v"}, "w"))} == {1: 3, 2: 1023}


def test_product_features(shop):
    rows = keyed(features.product_features(features.prior_full(shop)), "product_id")
    assert rows[(10,)]["p_total_orders"] == 4 and rows[(10,)]["p_unique_users"] == 2
    assert rows[(10,)]["p_reorder_rate"] == 0.5 and rows[(10,)]["p_department_id"] == 100


def test_user_product_features(shop):
    fact = features.prior_full(shop)
    rows = keyed(features.user_product_features(fact), "user_id", "product_id")
    milk = rows[(1, 10)]
    assert (milk["up_order_count"], milk["up_reorder_rate"]) == (3, 1.0)
    soap = rows[(1, 13)]
    assert soap["up_orders_since_last"] == 0 and soap["up_order_rate_since_first"] == 1.0
    given = features.user_product_features(fact, features.user_features(fact))
    assert keyed(given, "user_id", "product_id") == rows


def test_zero_denominator_gives_null(spark):
    # The only line is in the second order, so orders with lines minus first order plus one is 0.
    t = make_tables(spark, prior=[(2, 10, 1, 0)], train=[])
    rows = as_dicts(features.user_product_features(features.prior_full(t)))
    assert rows[0]["up_order_rate_since_first"] is None


def build_training(t):
    fact = features.prior_full(t)
    users = features.user_features(fact)
    return features.train_dataset(
        t, features.user_product_features(fact, users), users, features.product_features(fact)
    )


def test_training_labels(shop):
    rows = keyed(build_training(shop), "user_id", "product_id")
    labels = {key: row["reordered"] for key, row in rows.items()}
    # User 3 has no train order; product 14 was never bought before and is no candidate.
    assert labels == {(1, 10): 1, (1, 11): 0, (1, 12): 0, (1, 13): 0, (2, 11): 0}
    assert rows[(2, 11)]["p_total_orders"] == 3 and rows[(2, 11)]["u_total_items"] == 1


def test_training_set_straight_from_the_lines_is_the_same(shop):
    fact = features.prior_full(shop)
    own = fact.join(features.train_users(shop), "user_id", "left_semi")
    direct = features.train_dataset_of(shop, fact, own, features.RATIO_DEPARTMENTS)
    assert keyed(direct, "user_id", "product_id") == keyed(
        build_training(shop), "user_id", "product_id"
    )


def test_repeated_train_lines_do_not_fan_out(spark):
    t = make_tables(spark, train=[(4, 10, 1, 1), (4, 10, 2, 0)])
    rows = as_dicts(build_training(t))
    assert len(rows) == 5 and sum(r["reordered"] for r in rows) == 1


def test_rfv(shop):
    users = features.user_features(features.prior_full(shop))
    rows = keyed(features.rfv_features(shop, users), "user_id")
    assert rows[(1,)]["recency"] == 7.0 and rows[(1,)]["frequency"] == 3
    assert rows[(2,)]["recency"] == 0.0


def test_baskets_are_sorted_as_text_and_distinct(spark):
    t = make_tables(spark, prior=[(1, 9, 1, 0), (1, 10, 2, 0), (1, 10, 3, 0)])
    assert as_dicts(features.baskets(t)) == [{"order_id": 1, "items": ["10", "9"]}]


def test_partitioning_does_not_change_results(spark):
    once = make_tables(spark)
    import dataclasses

    spread = dataclasses.replace(
        once,
        orders=once.orders.repartition(7, "order_dow"),
        op_prior=once.op_prior.repartition(5, "product_id"),
        op_train=once.op_train.repartition(3),
        known={},
    )
    key = lambda r: (r["user_id"], r["product_id"])
    assert sorted(as_dicts(build_training(once)), key=key) == sorted(
        as_dicts(build_training(spread)), key=key
    )
    assert len(ORDERS) == once.orders.count()


@pytest.mark.parametrize("value", [-1, 1024, 2000, 1 << 40])
def test_modes_of_any_number(spark, value):
    df = spark.createDataFrame([(1, value, 1)], "k int, v long, w int")
    assert as_dicts(modes_per_key(df, "k", {"m": "v"}, "w")) == [{"k": 1, "m": value}]


def test_modes_of_mixed_types_against_counting(spark):
    """Texts, negative numbers, dates and a hot key, ties and sums, against plain counting."""
    draw = random.Random(7)
    rows = []
    for n in range(1500):
        key = "hot" if n % 3 == 0 else f"k{n % 40}"
        day = None if n % 11 == 0 else datetime.date(2020, 1, draw.randint(1, 4))
        text = draw.choice(["", "é", "Z", "a b", None])
        rows.append((key, text, draw.randint(-3, 3) * 10**10, day, draw.randint(1, 3), n))
    df = spark.createDataFrame(rows, "k string, t string, v long, d date, w int, s long")
    found = modes_per_key(df, "k", {"text": "t", "value": "v", "day": "d"}, "w", sums=("w", "s"))
    by_key: dict = {}
    for row in rows:
        by_key.setdefault(row[0], []).append(row)

    def mode(held, column):
        counts: dict = {}
        for row in held:
            if row[column] is not None:
                counts[row[column]] = counts.get(row[column], 0) + row[4]
        return min(counts, key=lambda value: (-counts[value], value)) if counts else None

    wanted = {
        key: (mode(held, 1), mode(held, 2), mode(held, 3), sum(row[4] for row in held), sum(row[5] for row in held))
        for key, held in by_key.items()
    }
    assert {r.k: (r.text, r.value, r.day, r.w, r.s) for r in found.collect()} == wanted


def test_modes_leave_nulls_out(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 1), (2, None, 1)], "k int, v int, w int")
    assert {r["k"]: r["m"] for r in as_dicts(modes_per_key(df, "k", {"m": "v"}, "w"))} == {1: 3, 2: None}


def test_features_from_the_fact_kept_by_user(spark, shop):
    stored = store_tables(spark, shop, 1)
    fact = features.user_fact(stored)
    assert fact is not features.user_fact(stored) and features.kept_by_user(stored)
    by_user = features.user_features(fact, dealt=True)
    assert keyed(by_user, "user_id") == keyed(features.user_features(features.prior_full(shop)), "user_id")
    pairs = features.user_product_features(fact)
    assert keyed(pairs, "user_id", "product_id") == keyed(
        features.user_product_features(features.prior_full(shop)), "user_id", "product_id"
    )
    for df in (by_user, fact.groupBy("user_id", "product_id").count()):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_user_with_too_many_lines_keeps_the_fact_by_order(spark, shop, monkeypatch):
    monkeypatch.setattr(features, "USER_LINES", 2)
    stored = store_tables(spark, shop, 1)
    fact = features.user_fact(stored)
    assert not features.kept_by_user(stored) and "fact_" not in str(stored.known)
    assert keyed(features.user_features(fact), "user_id") == keyed(
        features.user_features(features.prior_full(shop)), "user_id"
    )
    assert not features.kept_by_user(shop)


def test_product_features_shuffle_sums_per_product_only(spark, capsys):
    rows = [(n % 40, n % 7, n, 1 + n % 3, n % 2) for n in range(400)]
    fact = spark.createDataFrame(rows, "user_id long, product_id long, order_id long, add_to_cart_order int, reordered int")
    ones = {name: F.lit(1) for name in ("is_organic", "department_id", "aisle_id")}
    fact = fact.withColumns(ones)
    folder = f"{staging.required_folder(spark)}/product-features"
    fact.repartition(4, "user_id").write.bucketBy(4, "user_id").option("path", folder).saveAsTable("product_features_fact")
    try:
        table = features.product_features(spark.table("product_features_fact"))
        for row in as_dicts(table):
            own = [r for r in rows if r[1] == row["product_id"]]
            assert row["p_total_orders"] == len(own) and row["p_unique_users"] == len({r[0] for r in own})
            assert row["p_avg_add_to_cart_order"] == pytest.approx(sum(r[3] for r in own) / len(own))
            assert row["p_reorder_rate"] == pytest.approx(sum(r[4] for r in own) / len(own))
        capsys.readouterr()
        table.explain("simple")
        plan, _, _ = capsys.readouterr().out.partition("== Initial Plan ==")
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert shuffles and not any("user_id" in line.split("ENSURE")[0] for line in shuffles)
    finally:
        spark.sql("DROP TABLE IF EXISTS product_features_fact")

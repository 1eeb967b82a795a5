"""Shopping behaviour: order timing, basket size, customer journey, cart positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartloom.functions.labels import (
    day_name, has_token, percent, position_bucket, position_names, ratio,
)
from cartloom.operators.relational import stats_of, top_k
from cartloom.sources.schema import Tables

# Cart positions whose running counts one task adds up.
POSITION_BLOCK_BITS = 12


def _product_totals(lines: DataFrame) -> DataFrame:
    """Lines and reorders per product; dimensions are joined to this, not to the lines."""
    return lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sold"), F.sum("reordered").alias("reorders")
    )


def orders_by_day_hour(t: Tables) -> DataFrame:
    """Orders per day and hour with their share of all orders."""
    cells = t.orders.groupBy("order_dow", "order_hour_of_day").agg(
        F.count(F.lit(1)).alias("total_orders")
    )
    # The empty window runs over at most 7 x 24 rows.
    total = F.sum("total_orders").over(Window.partitionBy())
    return cells.select(
        "order_dow",
        day_name(F.col("order_dow")).alias("day_name"),
        "order_hour_of_day",
        "total_orders",
        percent(F.col("total_orders"), total).alias("pct_of_total"),
    ).orderBy("order_dow", "order_hour_of_day")


def pivot_day_hour(t: Tables) -> DataFrame:
    """Days in fixed order against 24 hour columns."""
    return (
        orders_by_day_hour(t)
        .groupBy("order_dow", "day_name")
        .pivot("order_hour_of_day", list(range(24)))
        .agg(F.sum("total_orders"))
        .fillna(0)
        .select("order_dow", "day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])
        .orderBy("order_dow")
    )


def order_gap_distribution(t: Tables) -> DataFrame:
    """Orders per number of days since the user's previous order, same-day orders left out."""
    return (
        t.orders.where(F.col("days_since_prior_order") > 0)
        .groupBy(F.col("days_since_prior_order").alias("days_since_prior"))
        .agg(F.count(F.lit(1)).alias("total_orders"))
        .orderBy("days_since_prior")
    )


def top_first_in_cart(t: Tables, k: int = 20) -> DataFrame:
    """Products most often put into the cart first."""
    firsts = (
        t.op_all.where(F.col("add_to_cart_order") == 1)
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("first_in_cart_count"))
    )
    named = firsts.join(t.products, "product_id").join(t.departments, "department_id")
    columns = ["product_id", "product_name", "department", "first_in_cart_count"]
    return top_k(named.select(*columns), [F.desc("first_in_cart_count"), F.asc("product_id")], k)


def basket_size_distribution(t: Tables, max_size: int | None = None) -> DataFrame:
    """Orders per number of lines, optionally up to a size."""
    sizes = t.op_all.groupBy("order_id").agg(F.count("product_id").alias("basket_size"))
    if max_size is not None:
        sizes = sizes.where(F.col("basket_size") <= max_size)
    return (
        sizes.groupBy("basket_size")
        .agg(F.count(F.lit(1)).alias("total_orders"))
        .orderBy("basket_size")
    )


def customer_journey(t: Tables, max_order: int = 50, digits: int = 2) -> DataFrame:
    """Basket size and weighted reorder rate by the how-manieth order of a user it is."""
    baskets = t.op_all.groupBy("order_id").agg(
        F.count("product_id").alias("basket_size"), F.sum("reordered").alias("reorders")
    )
    early = t.orders.where(F.col("order_number") <= max_order).select("order_id", "order_number")
    return (
        baskets.join(early, "order_id")
        .groupBy("order_number")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(F.avg("basket_size"), digits).alias("avg_basket_size"),
            percent(F.sum("reorders"), F.sum("basket_size")).alias("reorder_rate"),
        )
        .orderBy("order_number")
    )


def flag_comparison(t: Tables, token: str = "organic") -> DataFrame:
    """Sales and reorder rate of products with and without a word in their name."""
    category = F.when(has_token(F.col("product_name"), token), "Organic").otherwise("Non-Organic")
    return (
        _product_totals(t.op_all)
        .join(t.products, "product_id")
        .groupBy(category.alias("product_category"))
        .agg(
            F.sum("sold").alias("total_sold"),
            percent(F.sum("reorders"), F.sum("sold")).alias("reorder_rate"),
        )
        .orderBy("product_category")
    )


def aisle_sales(t: Tables, department: str = "produce") -> DataFrame:
    """Sales and reorder rate per aisle of one department."""
    chosen = t.departments.where(F.col("department") == department).select("department_id")
    shelf = t.products.join(chosen, "department_id", "left_semi").join(t.aisles, "aisle_id")
    return (
        _product_totals(t.op_all)
        .join(t.per_product(shelf.select("product_id", "aisle")), "product_id")
        .groupBy("aisle")
        .agg(
            F.sum("sold").alias("total_sales"),
            percent(F.sum("reorders"), F.sum("sold")).alias("reorder_rate"),
        )
        .orderBy(F.desc("total_sales"), F.asc("aisle"))
    )


def first_item_lifetime(t: Tables, min_users: int = 1000, digits: int = 2) -> DataFrame:
    """Lifetime orders of users by the department of the first item of their first order."""
    first_orders = t.orders.where(F.col("order_number") == 1).select("order_id", "user_id")
    first_items = t.op_all.where(F.col("add_to_cart_order") == 1).select("order_id", "product_id")
    lifetime = t.orders.groupBy("user_id").agg(F.max("order_number").alias("lifetime_orders"))
    return (
        first_orders.join(first_items, "order_id")
        .join(lifetime, "user_id")
        .join(t.products.select("product_id", "department_id"), "product_id")
        .join(t.departments, "department_id")
        .groupBy("department")
        .agg(
            F.count_distinct("user_id").alias("total_users"),
            F.round(F.avg("lifetime_orders"), digits).alias("avg_lifetime_orders"),
        )
        .where(F.col("total_users") > min_users)
        .orderBy(F.desc("avg_lifetime_orders"), F.asc("department"))
    )


def cart_position_buckets(
    t: Tables, probs: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8), digits: int = 1
) -> DataFrame:
    """Items, share and reorder rate of ranges of cart positions, five with the usual cuts.

    Everything is derived from one histogram of positions, so the lines are read once: a cut is
    the smallest position at which the running count reaches its share of all items. Running
    counts are made inside blocks of positions and over the blocks, so no task sees all positions
    of a very large order.
    """
    if not probs or any(not 0 < p < 1 for p in probs) or list(probs) != sorted(set(probs)):
        raise ValueError(f"shares must rise from above 0 to below 1: {probs}")
    position = F.col("add_to_cart_order")
    histogram = (
        t.op_all.groupBy("add_to_cart_order")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("reordered").alias("reorders"))
        .withColumn("block", F.shiftright("add_to_cart_order", POSITION_BLOCK_BITS))
    )
    before = (Window.unboundedPreceding, -1)
    blocks = histogram.groupBy("block").agg(F.sum("n").alias("block_n"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_n").over(Window.orderBy("block").rowsBetween(*before)), F.lit(0)).alias("earlier"),
        F.sum("block_n").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("block").orderBy("add_to_cart_order")
    running = histogram.join(blocks, "block").withColumn(
        "reached",
        F.col("earlier") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    )
    cuts = stats_of(
        running,
        **{
            f"p{index}": F.min(F.when(F.col("reached") >= F.col("total") * p, position))
            for index, p in enumerate(probs)
        },
    )
    fields = [cuts.getField(f"p{index}") for index in range(len(probs))]
    label = position_bucket(position, fields, position_names(len(probs)))
    return (
        running.groupBy(label.alias("cart_position_bucket"))
        .agg(
            F.sum("n").alias("total_items"),
            percent(F.sum("n"), F.max("total")).alias("pct_items_share"),
            percent(F.sum("reorders"), F.sum("n")).alias("avg_reorder_rate_pct"),
            F.round(ratio(F.sum(position * F.col("n")), F.sum("n")), digits).alias("avg_position"),
        )
        .orderBy("avg_position", "cart_position_bucket")
    )

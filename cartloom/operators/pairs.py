"""Counting products bought together.

A pair count has to look at every pair inside an order, so the work per order is quadratic. Three
things keep it distributable:

* callers narrow the lines to the products that can still matter before pairing;
* pairs are never stored: they stream from the unfolded item array into a partial count in the
  same stage, and only (product, product, count) rows are shuffled;
* an order above ``BLOCK`` products is cut into blocks, and each combination of two blocks
  becomes a unit of work of its own, spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.operators.relational import stats_of, top_k

# Products of one order that one task pairs at a time.
BLOCK = 1024

# Products tried first when looking for a lower bound on the top pairs.
SEEDS = 64


def pair_order() -> list[Column]:
    return [F.desc("co_occurrence"), F.asc("product_a_id"), F.asc("product_b_id")]


def _unfold_whole(lines: DataFrame) -> DataFrame:
    """Pairs of orders that are small enough to be one array."""
    baskets = lines.groupBy("order_id").agg(F.array_sort(F.collect_set("product_id")).alias("items"))
    return (
        baskets.where(F.size("items") > 1)
        .select("items", F.posexplode("items").alias("at", "product_a_id"))
        .select("product_a_id", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("product_b_id"))
    )


def _large_orders(lines: DataFrame, block: int) -> DataFrame:
    """Orders above ``block`` products and how many blocks they are cut into."""
    sizes = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    return sizes.select("order_id", F.ceil(F.col("n") / block).alias("parts"))


def _cells(own: Column, cell: Callable[[Column, Column], Column]) -> Column:
    """A cell for the block of a line with every block of its order."""
    every = F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)
    return F.transform(every, lambda other: cell(own, other))


def _own_block() -> Column:
    return F.pmod(F.xxhash64("product_id"), F.col("parts"))


def _unfold_blocks(lines: DataFrame, large: DataFrame) -> DataFrame:
    """Pairs of the large orders, one (order, block, block) cell at a time."""

    def cell(own: Column, other: Column) -> Column:
        return F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high"))

    routed = (
        lines.join(large, "order_id")
        .withColumn("own", _own_block())
        .select("order_id", "product_id", "own", F.inline(_cells(F.col("own"), cell)))
    )

    def side(name: str) -> Column:
        return F.collect_set(F.when(F.col("own") == F.col(name), F.col("product_id")))

    # Without the explicit shuffle Spark would keep all cells of an order in one task.
    grouped = routed.repartition("order_id", "low", "high").groupBy("order_id", "low", "high")
    crossed = (
        grouped.agg(side("low").alias("left"), side("high").alias("right"))
        .select("low", "high", "right", F.explode("left").alias("x"))
        .select("low", "high", "x", F.explode("right").alias("y"))
    )
    return crossed.where((F.col("low") < F.col("high")) | (F.col("x") < F.col("y"))).select(
        F.least("x", "y").alias("product_a_id"), F.greatest("x", "y").alias("product_b_id")
    )


def _without(lines: DataFrame, large: DataFrame) -> DataFrame:
    return lines.join(large.select("order_id"), "order_id", "left_anti")


def _counted(pairs: DataFrame, *ids: str) -> DataFrame:
    return pairs.groupBy(*ids).agg(F.count(F.lit(1)).alias("co_occurrence"))


def pair_counts(lines: DataFrame, largest_basket: int, block: int = BLOCK) -> DataFrame:
    """Orders holding both products, for every pair with a lower first id.

    ``largest_basket`` (an upper bound on distinct products per order) says whether there can be
    orders above ``block`` products. Only those are paired in blocks; all others stay whole.
    """
    ids = ("product_a_id", "product_b_id")
    lines = lines.select("order_id", "product_id")
    if largest_basket <= block:
        return _counted(_unfold_whole(lines), *ids)
    large = _large_orders(lines, block)
    whole, cut = _unfold_whole(_without(lines, large)), _unfold_blocks(lines, large)
    return _counted(whole.unionAll(cut), *ids)


def _across(lines: DataFrame, *keys: str) -> DataFrame:
    """Left and right products that share the keys."""

    def side(is_left: Column) -> Column:
        return F.collect_set(F.when(is_left, F.col("product_id")))

    return (
        lines.groupBy(*keys)
        .agg(side(F.col("is_left")).alias("left"), side(~F.col("is_left")).alias("right"))
        .where((F.size("left") > 0) & (F.size("right") > 0))
        .select("right", F.explode("left").alias("left_id"))
        .select("left_id", F.explode("right").alias("right_id"))
    )


def cross_pair_counts(sided: DataFrame, largest_basket: int, block: int = BLOCK) -> DataFrame:
    """Orders holding both a left and a right product; ``is_left`` names the side of each line."""
    lines = sided.select("order_id", "product_id", "is_left")
    if largest_basket <= block:
        return _counted(_across(lines, "order_id"), "left_id", "right_id")

    # In an order too large for one array a left product goes to one row of a grid of blocks and
    # a right product to one column; every cell then holds two short arrays.
    def cell(own: Column, other: Column) -> Column:
        left = F.col("is_left")
        row, column = F.when(left, own).otherwise(other), F.when(left, other).otherwise(own)
        return F.struct(row.alias("row"), column.alias("column"))

    large = _large_orders(lines, block)
    routed = lines.join(large, "order_id").select(
        "order_id", "product_id", "is_left", F.inline(_cells(_own_block(), cell))
    )
    cut = _across(routed.repartition("order_id", "row", "column"), "order_id", "row", "column")
    whole = _across(_without(lines, large), "order_id")
    return _counted(whole.unionAll(cut), "left_id", "right_id")


def top_pair_counts(
    lines: DataFrame,
    k: int,
    largest_basket: int,
    small: Callable[[DataFrame], DataFrame],
    frequency: DataFrame,
    seeds: int = SEEDS,
    block: int = BLOCK,
) -> DataFrame:
    """The k most frequent pairs of the products in ``frequency`` (product_id, lines).

    The pairs among the ``seeds`` most bought products give k real counts; the smallest of them
    is a floor. A pair occurs at most as often as its rarer product has lines, so products with
    fewer lines than the floor are left out before pairing. ``small`` marks a relation of one
    row per product for broadcast where that is safe.
    """
    lines = lines.select("order_id", "product_id")
    seed = top_k(frequency, [F.desc("lines"), F.asc("product_id")], seeds).select("product_id")
    # The seeds are limited in number, so this broadcast has a fixed size.
    seed_lines = lines.join(F.broadcast(seed), "product_id", "left_semi")
    best = top_k(pair_counts(seed_lines, min(largest_basket, seeds), block), pair_order(), k)
    found = stats_of(best, n=F.count(F.lit(1)), least=F.min("co_occurrence"))
    floor = F.when(found.getField("n") >= k, found.getField("least")).otherwise(F.lit(0))

    eligible = frequency.where(F.col("lines") >= floor).select("product_id")
    kept = lines.join(small(eligible), "product_id", "left_semi")
    return top_k(pair_counts(kept, largest_basket, block), pair_order(), k)

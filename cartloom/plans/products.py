"""Product and department segments, products bought together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.functions.labels import (
    BOOST, BOTH_FLAGGED, CORE, DEPARTMENT_SEGMENTS, MAINSTREAM, MIXED_FLAGGED, NONE_FLAGGED,
    POTENTIAL, flag, has_token, pair_type, percent, quadrant, ratio,
)
from cartloom.operators.pairs import cross_pair_counts, pair_counts, pair_order, top_pair_counts
from cartloom.operators.quantiles import exact_quantiles
from cartloom.operators.relational import top_k
from cartloom.sources.schema import Tables
from cartloom.sources.staging import remembered


def product_metrics(t: Tables) -> DataFrame:
    """Purchases, distinct buyers and mean reorder mark per product; derived once per input."""
    return remembered(t, "product-metrics", lambda: _product_metrics(t))


def product_lines(t: Tables) -> DataFrame:
    """Lines per product; derived once per input."""
    counts = lambda: t.op_all.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    return remembered(t, "product-lines", counts)


def _product_metrics(t: Tables) -> DataFrame:
    return (
        t.op_all.join(t.orders.select("order_id", "user_id"), "order_id")
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("total_purchases"),
            F.count_distinct("user_id").alias("total_unique_buyers"),
            F.avg("reordered").alias("reorder_rate"),
        )
    )


def product_thresholds(metrics: DataFrame, min_purchases: int = 100) -> Column:
    """Median reach and loyalty of the products bought often enough, as one struct value."""
    often = metrics.where(F.col("total_purchases") >= min_purchases)
    return exact_quantiles(
        often, {"reach_median": ("total_unique_buyers", 0.5), "loyalty_median": ("reorder_rate", 0.5)}
    )


def product_segments(
    t: Tables,
    token: str = "organic",
    median_min_purchases: int = 100,
    min_core: int = 0,
    min_potential: int = 0,
) -> DataFrame:
    """Every sold product with its metrics, flag and segment.

    With floors, a core or potential product that does not sell more than its floor counts as
    one to boost.
    """
    metrics = product_metrics(t)
    cut = product_thresholds(metrics, median_min_purchases)
    wide = F.col("total_unique_buyers") >= cut.getField("reach_median")
    loyal = F.col("reorder_rate") >= cut.getField("loyalty_median")
    segment = quadrant(wide, loyal, (CORE, MAINSTREAM, POTENTIAL, BOOST))
    if min_core or min_potential:
        below = ((segment == CORE) & (F.col("total_purchases") <= min_core)) | (
            (segment == POTENTIAL) & (F.col("total_purchases") <= min_potential)
        )
        segment = F.when(below, BOOST).otherwise(segment)
    flagged = has_token(F.col("product_name"), token)
    return (
        metrics.join(t.products, "product_id")
        .join(t.departments, "department_id")
        .select(
            "product_id",
            "product_name",
            "department_id",
            "department",
            "total_purchases",
            "total_unique_buyers",
            "reorder_rate",
            flag(flagged).alias("is_organic"),
            F.when(flagged, "Organic").otherwise("Non-Organic").alias("organic_label"),
            segment.alias("product_segment"),
        )
    )


def product_pairs(t: Tables) -> DataFrame:
    """How many orders hold both products, for every pair of products."""
    return pair_counts(t.op_all, t.largest_basket())


# Columns of one side of the pair table: attribute of the product -> name without the side.
_SIDE = {
    "product_name": "product",
    "department_id": "department_id",
    "department": "department",
    "is_organic": "is_organic",
    "organic_label": "organic_label",
    "product_segment": "segment",
    "total_purchases": "total_purchases",
    "total_unique_buyers": "total_unique_buyers",
}


def _side(segments: DataFrame, side: str) -> DataFrame:
    columns = [F.col("product_id").alias(f"product_{side}_id")]
    for attribute, base in _SIDE.items():
        columns.append(F.col(attribute).alias(f"{base}_{side}"))
    columns.append(F.round(F.col("reorder_rate") * 100.0, 2).alias(f"reorder_rate_{side}"))
    return segments.select(*columns)


def enrich_pairs(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Attributes of both products next to a pair count."""
    sided = ["product", "department_id", "department", "is_organic", "organic_label"]
    measured = ["segment", "total_purchases", "total_unique_buyers", "reorder_rate"]

    def both(bases: list[str]) -> list[str]:
        return [f"{base}_{side}" for base in bases for side in "ab"]

    return (
        pairs.join(_side(segments, "a"), "product_a_id")
        .join(_side(segments, "b"), "product_b_id")
        .select(
            "product_a_id",
            "product_b_id",
            *both(sided),
            pair_type(F.col("is_organic_a"), F.col("is_organic_b")).alias("organic_pair_type"),
            *both(measured),
            "co_occurrence",
        )
    )


def product_pair_base(t: Tables, top_pairs: int | None = None, **segment_options) -> DataFrame:
    """All pairs with the attributes of both sides, or only the most frequent pairs.

    Pairs are counted on ids alone; attributes are joined to the counts afterwards.
    """
    segments = product_segments(t, **segment_options)
    if top_pairs is None:
        return enrich_pairs(product_pairs(t), t.per_product(segments))
    best = top_pair_counts(t.op_all, top_pairs, t.largest_basket(), t.per_product, product_lines(t))
    return enrich_pairs(F.broadcast(best), segments)


_TOP_PAIR_COLUMNS = [
    "product_a", "product_b", "is_organic_a", "is_organic_b", "organic_pair_type", "segment_a",
    "segment_b", "co_occurrence",
]


def top_pairs(t: Tables, min_purchases: int = 50_000, k: int = 15, **segment_options) -> DataFrame:
    """Most frequent pairs of two products that both sell more than ``min_purchases``.

    Lines of other products are dropped before pairing, and names are looked up for k rows only.
    """
    segments = product_segments(t, **segment_options)
    often = product_metrics(t).where(F.col("total_purchases") > min_purchases).select("product_id")
    best = top_pair_counts(
        t.op_all, k, t.largest_basket(), t.per_product, product_lines(t).join(often, "product_id", "left_semi")
    )
    return top_k(enrich_pairs(F.broadcast(best), segments), pair_order(), k).select(
        *_TOP_PAIR_COLUMNS
    )


def top_pairs_of(base: DataFrame, min_purchases: int = 50_000, k: int = 15) -> DataFrame:
    """``top_pairs`` read from a stored pair table."""
    often = (F.col("total_purchases_a") > min_purchases) & (
        F.col("total_purchases_b") > min_purchases
    )
    return top_k(base.where(often), pair_order(), k).select(*_TOP_PAIR_COLUMNS)


def pair_labels(pairs: DataFrame, width: int = 22) -> DataFrame:
    """Short label and readable type of each pair."""
    readable = (
        F.when(F.col("organic_pair_type") == BOTH_FLAGGED, "Organic + Organic")
        .when(F.col("organic_pair_type") == NONE_FLAGGED, "Non-Organic + Non-Organic")
        .when(F.col("organic_pair_type") == MIXED_FLAGGED, "Mixed")
    )
    short = [F.substring(name, 1, width) for name in ("product_a", "product_b")]
    return pairs.select(
        F.concat_ws(" + ", *short).alias("pair_label"),
        readable.alias("pair_type"),
        "co_occurrence",
    )


def potential_core_pairs(t: Tables, k: int = 10, **segment_options) -> DataFrame:
    """Most frequent pairs of a potential product with a core product.

    Only lines of these two segments are read into the pairing, and only across the segments.
    """
    segments = product_segments(t, **segment_options)
    sides = segments.where(F.col("product_segment").isin(POTENTIAL, CORE)).select(
        "product_id", (F.col("product_segment") == POTENTIAL).alias("is_left")
    )
    lines = t.op_all.select("order_id", "product_id").join(t.per_product(sides), "product_id")
    counted = cross_pair_counts(lines, t.largest_basket())
    oriented = counted.select(
        F.least("left_id", "right_id").alias("product_a_id"),
        F.greatest("left_id", "right_id").alias("product_b_id"),
        "left_id",
        "right_id",
        "co_occurrence",
    )
    best = F.broadcast(top_k(oriented, pair_order(), k))

    def attributes(key: str, name: str) -> DataFrame:
        return segments.select(
            F.col("product_id").alias(key),
            F.col("product_name").alias(name),
            F.col("is_organic").alias(f"{name}_flag"),
            F.round(F.col("reorder_rate") * 100.0, 2).alias(f"{name}_reorder_rate"),
            F.col("total_purchases").alias(f"{name}_total_purchases"),
        )

    named = best.join(attributes("left_id", "hidden_gem"), "left_id").join(
        attributes("right_id", "blockbuster"), "right_id"
    )
    return top_k(named, pair_order(), k).select(
        "hidden_gem",
        "blockbuster",
        pair_type(F.col("hidden_gem_flag"), F.col("blockbuster_flag")).alias("organic_pair_type"),
        "co_occurrence",
        "hidden_gem_reorder_rate",
        "hidden_gem_total_purchases",
        "blockbuster_reorder_rate",
        "blockbuster_total_purchases",
    )


def potential_core_pairs_of(base: DataFrame, k: int = 10) -> DataFrame:
    """``potential_core_pairs`` read from a stored pair table."""
    a, b = F.col("segment_a"), F.col("segment_b")
    mixed = ((a == POTENTIAL) & (b == CORE)) | ((a == CORE) & (b == POTENTIAL))

    def pick(attribute: str, segment: str) -> Column:
        return F.when(a == segment, F.col(f"{attribute}_a")).otherwise(F.col(f"{attribute}_b"))

    return top_k(base.where(mixed), pair_order(), k).select(
        pick("product", POTENTIAL).alias("hidden_gem"),
        pick("product", CORE).alias("blockbuster"),
        "organic_pair_type",
        "co_occurrence",
        pick("reorder_rate", POTENTIAL).alias("hidden_gem_reorder_rate"),
        pick("total_purchases", POTENTIAL).alias("hidden_gem_total_purchases"),
        pick("reorder_rate", CORE).alias("blockbuster_reorder_rate"),
        pick("total_purchases", CORE).alias("blockbuster_total_purchases"),
    )


def pair_node_strength(pairs: DataFrame, left: str = "hidden_gem", right: str = "blockbuster") -> DataFrame:
    """Summed co-occurrence per product over the undirected edges it takes part in."""
    return (
        pairs.select(F.explode(F.array(left, right)).alias("product"), "co_occurrence")
        .groupBy("product")
        .agg(F.sum("co_occurrence").alias("strength"))
        .orderBy(F.desc("strength"), F.asc("product"))
    )


def top_potential_products(t: Tables, k: int = 10, **segment_options) -> DataFrame:
    """Best selling potential products among those that were ever bought with another product.

    Being in some pair means having been in an order of two or more products, which needs the
    size of each order but no pairs.
    """
    segments = product_segments(t, **segment_options).where(F.col("product_segment") == POTENTIAL)
    potential = t.per_product(segments.select("product_id"))
    lines = t.op_all.select("order_id", "product_id").join(potential, "product_id", "left_semi")
    products = t.op_all.groupBy("order_id").agg(F.min("product_id").alias("low"), F.max("product_id").alias("high"))
    shared = products.where(F.col("low") < F.col("high"))
    paired = lines.join(shared, "order_id", "left_semi").select("product_id").distinct()
    found = segments.join(t.per_product(paired), "product_id", "left_semi").select(
        "product_id",
        "product_name",
        "department",
        "product_segment",
        F.col("total_purchases").alias("total_volume"),
        F.round(F.col("reorder_rate") * 100.0, 2).alias("reorder_rate"),
        F.col("total_unique_buyers").alias("unique_users"),
    )
    return top_k(found, [F.desc("total_volume"), F.asc("product_id")], k)


def pair_products(base: DataFrame) -> DataFrame:
    """Distinct products of a pair table: both sides of each row are unfolded in one pass."""
    # Output column -> column of the pair table without its side.
    columns = {
        "product_id": "product_{}_id",
        "product_name": "product_{}",
        "department_id": "department_id_{}",
        "department": "department_{}",
        "product_segment": "segment_{}",
        "total_purchases": "total_purchases_{}",
        "total_unique_buyers": "total_unique_buyers_{}",
        "reorder_rate": "reorder_rate_{}",
    }
    sides = [
        F.struct(*[F.col(source.format(side)).alias(name) for name, source in columns.items()])
        for side in "ab"
    ]
    return base.select(F.inline(F.array(*sides))).distinct()


def top_potential_products_of(base: DataFrame, k: int = 10) -> DataFrame:
    """``top_potential_products`` read from a stored pair table."""
    found = pair_products(base).where(F.col("product_segment") == POTENTIAL)
    return top_k(found, [F.desc("total_purchases"), F.asc("product_id")], k).select(
        "product_id",
        "product_name",
        "department",
        "product_segment",
        F.col("total_purchases").alias("total_volume"),
        "reorder_rate",
        F.col("total_unique_buyers").alias("unique_users"),
    )


def register_result_views(pair_base: DataFrame, matrix: DataFrame) -> None:
    """Make the pair table and the department matrix reachable from ``spark.sql``."""
    pair_base.createOrReplaceTempView("product_pair_base")
    matrix.createOrReplaceTempView("department_matrix")


def median_of(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.median(column).alias(name))


def department_matrix(t: Tables, digits: int = 2) -> DataFrame:
    """Reach and loyalty of departments against the medians over all departments.

    Lines are first added up per (order, department) and then per (user, department), so distinct
    orders and users are plain row counts and no line is multiplied for a distinct count.
    """
    shelf = t.products.join(t.departments.select("department_id"), "department_id", "left_semi")
    shelf = t.per_product(shelf.select("product_id", "department_id"))
    in_order = (
        t.op_all.join(shelf, "product_id")
        .groupBy("order_id", "department_id")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("reordered").alias("reorders"))
    )
    of_user = (
        in_order.join(t.orders.select("order_id", "user_id"), "order_id")
        .groupBy("user_id", "department_id")
        .agg(
            F.sum("items").alias("items"),
            F.sum("reorders").alias("reorders"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    metrics = of_user.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("total_unique_buyers"),
        percent(F.sum("reorders"), F.sum("items")).alias("reorder_rate"),
        F.round(ratio(F.sum("items"), F.sum("orders")), digits).alias("avg_items_per_order"),
        F.sum("items").alias("total_purchases"),
    )
    sold = product_metrics(t).join(shelf, "product_id").groupBy("department_id")
    sold = sold.agg(F.count(F.lit(1)).alias("total_products"))
    # A window over one row per department, so that the lines are not added up again for the medians.
    every = Window.partitionBy()
    metrics = metrics.withColumns(
        {
            "reach_median": F.percentile_approx("total_unique_buyers", 0.5).over(every),
            "loyalty_median": F.percentile_approx("reorder_rate", 0.5).over(every),
        }
    )
    wide = F.col("total_unique_buyers") >= F.col("reach_median")
    loyal = F.col("reorder_rate") >= F.col("loyalty_median")
    return (
        metrics.join(sold, "department_id")
        .join(t.departments, "department_id")
        .select(
            "department_id",
            "department",
            quadrant(wide, loyal, DEPARTMENT_SEGMENTS).alias("department_segment"),
            "total_unique_buyers",
            "reorder_rate",
            "avg_items_per_order",
            "total_products",
            "total_purchases",
            "reach_median",
            "loyalty_median",
        )
        .orderBy(F.desc("department"))
    )


def segment_rank() -> Column:
    """Place of a department's segment in report order."""
    return F.array_position(F.array(*map(F.lit, DEPARTMENT_SEGMENTS)), F.col("department_segment"))


def segment_sort(matrix: DataFrame) -> DataFrame:
    """Departments by segment in report order, widest reach first."""
    return matrix.orderBy(segment_rank(), F.desc("total_unique_buyers"), F.asc("department_id"))

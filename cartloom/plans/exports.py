"""Small tables for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartloom.functions.labels import flag, has_token, ratio
from cartloom.operators.relational import top_k
from cartloom.sources.schema import Tables


def hourly_heatmap(t: Tables) -> DataFrame:
    """Orders per day and hour, at most 168 rows."""
    return (
        t.orders.groupBy("order_dow", "order_hour_of_day")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy("order_dow", "order_hour_of_day")
    )


def _prior_sales(t: Tables) -> DataFrame:
    """Prior lines and reorders per product."""
    prior_orders = t.orders.where(F.col("eval_set") == "prior").select("order_id")
    return (
        t.op_prior.join(prior_orders, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("reordered").alias("reorders"))
    )


def top_products(t: Tables, k: int = 500, token: str = "organic") -> DataFrame:
    """Most ordered products with their reorder rate."""
    named = (
        _prior_sales(t)
        .join(t.products, "product_id")
        .join(t.aisles, "aisle_id", "left")
        .join(t.departments, "department_id", "left")
        .select(
            "product_id",
            "product_name",
            "department",
            "aisle",
            flag(has_token(F.col("product_name"), token)).alias("is_organic"),
            F.col("n").alias("total_orders"),
            F.round(ratio(F.col("reorders"), F.col("n")), 4).alias("reorder_rate"),
        )
    )
    return top_k(named, [F.desc("total_orders"), F.asc("product_id")], k)


def department_stats(t: Tables) -> DataFrame:
    """Lines, reorder rate and number of products per department."""
    return (
        _prior_sales(t)
        .join(t.products.select("product_id", "department_id"), "product_id")
        .join(t.departments, "department_id", "left")
        .groupBy("department_id", "department")
        .agg(
            F.sum("n").alias("total_orders"),
            F.round(ratio(F.sum("reorders"), F.sum("n")), 4).alias("reorder_rate"),
            F.count(F.lit(1)).alias("unique_products"),
        )
        .orderBy(F.desc("total_orders"), F.asc("department_id"))
    )

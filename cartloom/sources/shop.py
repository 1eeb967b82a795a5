"""The basket tables derived from the order, line and part tables of a wholesale schema.

``derive_tables`` is the lazy derivation. ``shop_tables`` runs it once per input, writes the
result to the shared folder bucketed by order, and hands out scans of it; every later query then
reads pruned columns of ready tables and joins orders to lines without a shuffle.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cartloom.sources import staging
from cartloom.sources.schema import BROADCAST_BYTES, Tables, conform

# Up to this many orders per user, one task can number the orders of any user.
WINDOW_ORDERS = 1_000_000

# Two ids and what Spark keeps with them.
MAPPING_ROW_BYTES = 48

# Beyond it, the orders of one user on one day are numbered in blocks of this many neighbouring
# order ids, so that no task ever sorts more than one block.
_BLOCK_BITS = 16

_staged: dict[tuple, dict] = {}
_scans: dict[tuple, tuple[SparkSession, Tables]] = {}
_lock = threading.Lock()


def _named_products(part: DataFrame) -> DataFrame:
    """One product per (name, type) with the names of its aisle and department."""
    return (
        part.select(
            "p_partkey",
            _product_name().alias("product_name"),
            F.get(F.split("p_name", " "), F.lit(1)).alias("aisle"),
            F.col("p_type").alias("department"),
        )
        .groupBy("product_name", "aisle", "department")
        .agg(F.min("p_partkey").alias("product_id"))
    )


def _product_name() -> Column:
    return F.concat_ws(" ", "p_name", "p_type")


def _dimension(named: DataFrame, name: str) -> DataFrame:
    return named.groupBy(name).agg(F.min("product_id").alias(f"{name}_id")).select(f"{name}_id", name)


def _products(named: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    return conform(named.join(aisles, "aisle").join(departments, "department"), "products")


def heaviest_user(orders: DataFrame) -> int:
    """Most orders of one user."""
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _numbered(orders: DataFrame) -> DataFrame:
    """Order number, previous day and last-order mark per user, by one window per user."""
    user = Window.partitionBy("user_id")
    sequence = user.orderBy("day", "order_id")
    return orders.withColumns(
        {
            "order_number": F.row_number().over(sequence),
            "days_since_prior_order": F.datediff("day", F.lag("day").over(sequence)),
            "is_last": F.lead("order_id").over(sequence).isNull(),
        }
    )


def _numbered_in_blocks(orders: DataFrame) -> DataFrame:
    """The same columns where a user may hold any share of all orders.

    Counts per (user, day, block) are added up: the windows below run over the blocks of one day
    and over calendar days, and only the rows of one block are ever ranked together.
    """
    orders = orders.withColumn("block", F.shiftright("order_id", _BLOCK_BITS))
    in_day = Window.partitionBy("user_id", "day").orderBy("block")
    by_day = Window.partitionBy("user_id").orderBy("day")
    before = (Window.unboundedPreceding, -1)

    def running(count: str, window) -> Column:
        return F.coalesce(F.sum(count).over(window.rowsBetween(*before)), F.lit(0))

    blocks = orders.groupBy("user_id", "day", "block").agg(F.count(F.lit(1)).alias("n"))
    days = blocks.groupBy("user_id", "day").agg(F.sum("n").alias("day_orders"))
    days = days.withColumns(
        {
            "before_day": running("day_orders", by_day),
            "previous_day": F.lag("day").over(by_day),
            "user_orders": F.sum("day_orders").over(Window.partitionBy("user_id")),
        }
    )
    offsets = blocks.withColumn("before_block", running("n", in_day)).drop("n")
    offsets = offsets.join(days, ["user_id", "day"])

    rank = F.row_number().over(Window.partitionBy("user_id", "day", "block").orderBy("order_id"))
    in_day_rank = F.col("before_block") + F.col("rank")
    gap = F.when(in_day_rank > 1, F.lit(0)).otherwise(F.datediff("day", "previous_day"))
    return (
        orders.join(offsets, ["user_id", "day", "block"])
        .withColumn("rank", rank)
        .withColumn("order_number", F.col("before_day") + in_day_rank)
        .withColumn("days_since_prior_order", gap)
        .withColumn("is_last", F.col("order_number") == F.col("user_orders"))
    )


def derive_orders(orders: DataFrame, most_orders: int) -> DataFrame:
    dated = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
    )
    if most_orders <= WINDOW_ORDERS:
        numbered = _numbered(dated)
    else:
        # Only users beyond the limit are numbered in blocks.
        sizes = dated.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        heavy = sizes.where(F.col("n") > WINDOW_ORDERS).select("user_id")
        columns = ["order_id", "user_id", "day", "order_number", "days_since_prior_order", "is_last"]
        numbered = _numbered(dated.join(heavy, "user_id", "left_anti")).select(*columns).unionByName(
            _numbered_in_blocks(dated.join(heavy, "user_id", "left_semi")).select(*columns)
        )
    eval_set = (
        F.when(~F.col("is_last"), "prior").when(F.col("user_id") % 3 == 0, "test").otherwise("train")
    )
    timed = numbered.withColumns(
        {
            "eval_set": eval_set,
            "order_dow": F.dayofweek("day") - 1,
            "order_hour_of_day": (F.col("order_id") * 7) % 24,
        }
    )
    return conform(timed, "orders")


def derive_lines(
    lineitem: DataFrame, part: DataFrame, products: DataFrame, orders: DataFrame, most_orders: int
) -> DataFrame:
    """Order lines with cart position, reorder mark and the set their order belongs to."""
    mapping = (
        part.select("p_partkey", _product_name().alias("product_name"))
        .join(products.select("product_name", "product_id"), "product_name")
        .select("p_partkey", "product_id")
    )
    # Unaided, the planner overrates a join's size and would rather broadcast the lines.
    if part.count() * MAPPING_ROW_BYTES <= BROADCAST_BYTES:
        mapping = F.broadcast(mapping)
    # One order holds a product once, so this window is bounded by the catalogue.
    cart = Window.partitionBy("order_id").orderBy("line", "product_id")
    bought = (
        lineitem.select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber")
        .join(mapping, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("order_id", "product_id")
        .agg(F.min("l_linenumber").alias("line"))
        .withColumn("add_to_cart_order", F.row_number().over(cart))
        .join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    )
    first = F.min("order_number")
    if most_orders <= WINDOW_ORDERS:
        # A user's orders bound the rows of one (user, product).
        same = Window.partitionBy("user_id", "product_id")
        bought = bought.withColumn("first_order", first.over(same))
    else:
        firsts = bought.groupBy("user_id", "product_id").agg(first.alias("first_order"))
        bought = bought.join(firsts, ["user_id", "product_id"])
    return bought.where(F.col("eval_set") != "test").select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.col("first_order")).cast("int").alias("reordered"),
        "eval_set",
    )


def derive_tables(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> Tables:
    """The logical tables as lazy plans over the source tables."""
    named = _named_products(part)
    aisles, departments = _dimension(named, "aisle"), _dimension(named, "department")
    products = _products(named, aisles, departments)
    most = heaviest_user(orders)
    shop_orders = derive_orders(orders, most)
    lines = derive_lines(lineitem, part, products, shop_orders, most)
    return staging.bundle(shop_orders, lines, products, aisles, departments)


def _stage(spark: SparkSession, sources: list[DataFrame], folder: str, input_bytes: int) -> dict:
    """Write the derived tables and say where they are.

    Every table is read back before the next one uses it, so the planner sees its real size.
    """
    orders, lineitem, part = sources
    store = staging.Store.open(spark, folder, input_bytes)
    named = store.plain("named_products", _named_products(part))
    aisles = store.plain("aisles", _dimension(named, "aisle"))
    departments = store.plain("departments", _dimension(named, "department"))
    products = store.plain("products", _products(named, aisles, departments))
    most = heaviest_user(orders)
    shop_orders = store.by_order("orders", derive_orders(orders, most))
    lines = derive_lines(lineitem, part, products, shop_orders, most)
    store.by_order("lines", lines, partition="eval_set")
    return store.where


def shop_tables(spark: SparkSession, folder: str) -> Tables:
    """Basket tables for the Parquet files in ``folder``, staged on first use."""
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in ("orders", "lineitem", "part")]
    shared = staging.required_folder(spark)
    input_bytes, marker = staging.input_state(spark, paths)
    key = (spark.sparkContext.applicationId, marker)
    with _lock:
        if key not in _staged:
            sources = [spark.read.parquet(path) for path in paths]
            _staged[key] = _stage(spark, sources, shared, input_bytes)
        session, tables = _scans.get(key, (None, None))
        if session is not spark:
            tables = staging.scan(spark, _staged[key])
            _scans[key] = (spark, tables)
        return tables


def release_tables(spark: SparkSession) -> None:
    """Forget and drop all staged tables of this application."""
    with _lock:
        for known in (_staged, _scans):
            for key in [key for key in known if key[0] == spark.sparkContext.applicationId]:
                del known[key]
        staging.drop_stores(spark)

"""Logical schemas of the basket data set and the table bundle every plan takes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _struct(*columns: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


_LINES = _struct(
    ("order_id", LongType()),
    ("product_id", LongType()),
    ("add_to_cart_order", IntegerType()),
    ("reordered", IntegerType()),
)

# One explicit schema per logical table: nothing is inferred, so a scan never reads a file twice.
SCHEMAS: dict[str, StructType] = {
    "orders": _struct(
        ("order_id", LongType()),
        ("user_id", LongType()),
        ("eval_set", StringType()),
        ("order_number", IntegerType()),
        ("order_dow", IntegerType()),
        ("order_hour_of_day", IntegerType()),
        ("days_since_prior_order", DoubleType()),
    ),
    "op_prior": _LINES,
    "op_train": _LINES,
    "products": _struct(
        ("product_id", LongType()),
        ("product_name", StringType()),
        ("aisle_id", LongType()),
        ("department_id", LongType()),
    ),
    "aisles": _struct(("aisle_id", LongType()), ("aisle", StringType())),
    "departments": _struct(("department_id", LongType()), ("department", StringType())),
}

# File names of the public data set.
CSV_FILES: dict[str, str] = {
    "orders": "orders.csv",
    "op_prior": "order_products__prior.csv",
    "op_train": "order_products__train.csv",
    "products": "products.csv",
    "aisles": "aisles.csv",
    "departments": "departments.csv",
}

# Names under which the tables are visible to SQL.
VIEW_NAMES: dict[str, str] = {
    "orders": "orders",
    "op_prior": "order_products_prior",
    "op_train": "order_products_train",
    "op_all": "order_products_all",
    "products": "products",
    "aisles": "aisles",
    "departments": "departments",
}


# A relation with one row per product is sent to every task up to this many bytes.
BROADCAST_BYTES = 64 << 20
# Numbers and labels next to the names in such a row.
PRODUCT_ROW_BYTES = 256


@dataclass(frozen=True)
class Tables:
    """The seven logical tables. ``op_all`` holds prior and train lines together.

    ``known`` remembers the few sizes plans choose by and where small derived tables were written,
    so each is measured or derived at most once.
    """

    orders: DataFrame
    op_prior: DataFrame
    op_train: DataFrame
    op_all: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    known: dict = field(default_factory=dict, repr=False, compare=False)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in VIEW_NAMES]

    def product_bytes(self) -> int:
        """Upper bound on the size of a relation of one row per product with all its names."""
        if "product_bytes" not in self.known:
            names = F.coalesce(F.octet_length("product_name"), F.lit(0)) + PRODUCT_ROW_BYTES
            self.known["product_bytes"] = self.products.agg(F.coalesce(F.sum(names), F.lit(0))).first()[0]
        return self.known["product_bytes"]

    def largest_basket(self) -> int:
        """Most lines in one order: an upper bound on the distinct products of any order."""
        if "largest_basket" not in self.known:
            sizes = self.op_all.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
            largest = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
            self.known["largest_basket"] = int(largest)
        return self.known["largest_basket"]

    def per_product(self, df: DataFrame) -> DataFrame:
        """Mark a relation of at most one row per product for broadcast if it is small.

        Spark cannot tell the size of a derived relation before it runs and would shuffle the
        lines by product, where one product may hold a large part of them. With many products the
        relation is left to a shuffled join, whose skewed partitions Spark splits at run time.
        """
        return F.broadcast(df) if self.product_bytes() <= BROADCAST_BYTES else df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table``; ids widen to long."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])

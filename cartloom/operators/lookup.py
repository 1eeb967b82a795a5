"""Names for arrays of ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _tagged(side: str) -> Callable[[Column, Column], Column]:
    return lambda value, at: F.struct(F.lit(side).alias("side"), at.alias("at"), value.alias("id"))


def names_for(df: DataFrame, arrays: Mapping[str, str], products: DataFrame) -> DataFrame:
    """Add, for each id array, an array of product names in the same order.

    ``arrays`` maps id columns to name columns; unknown ids stay as they are. Rows of ``df`` must
    be distinct. The ids of all arrays are unfolded together, joined once and folded again, so
    the product table is neither collected nor shipped to a Python function.
    """
    entries = F.concat(*[F.transform(ids, _tagged(names)) for ids, names in arrays.items()])
    lookup = products.select(F.col("product_id").cast("string").alias("id"), "product_name")
    unfolded = df.select("*", F.explode_outer(entries).alias("entry"))
    named = unfolded.select(*df.columns, "entry.*").join(lookup, "id", "left")
    entry = F.struct("at", F.coalesce("product_name", "id").alias("name"))
    folded = named.groupBy(*df.columns).agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("side") == names, entry))).alias(names)
            for names in arrays.values()
        ]
    )
    return folded.select(
        *df.columns, *[F.col(f"{names}.name").alias(names) for names in arrays.values()]
    )

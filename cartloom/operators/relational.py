"""Small relational building blocks shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.functions.labels import ratio


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First k rows in a total order; each task keeps k rows, so no full sort happens."""
    return df.orderBy(*order).limit(k)


def stats_of(df: DataFrame, **aggregates: Column) -> Column:
    """Whole-table statistics as one struct value, usable in any expression.

    It is an uncorrelated scalar subquery: computed once and inlined, with no join.
    """
    named = [column.alias(name) for name, column in aggregates.items()]
    return df.agg(*named).select(F.struct("*").alias("stats")).scalar()


def with_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add numerator / denominator columns."""
    return df.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in ratios.items()})


def modes_per_key(
    df: DataFrame,
    key: str,
    values: Mapping[str, str],
    weight: str,
    sums: Sequence[str] = (),
    dealt: bool = False,
) -> DataFrame:
    """Most frequent value per key for several columns of any orderable types.

    The smallest value wins a tie, nulls are left out. All columns share one aggregation: rows are
    unfolded to (column, value) and counted. Of the values that a key has equally often the smallest
    stays, then the one with the highest count; both steps run on rows that are dealt out by key
    already, as plain minima and maxima. Sums per key (``sums``) ride along, so that rows need not
    be read again for them. ``dealt`` rows come from storage by the key and are not shuffled.
    """
    names = list(values)

    def entry(kind: str) -> Column:
        own = [(F.col(values[n]) if n == kind else F.lit(None).cast(df.schema[values[n]].dataType)) for n in names]
        return F.struct(F.lit(kind).alias("kind"), *[column.alias(f"value_{n}") for n, column in zip(names, own)])

    slots = [f"value_{name}" for name in names]
    unfolded = df.select(
        key,
        weight,
        *[column for column in sums if column != weight],
        F.explode(F.array(*map(entry, names))).alias("v"),
    ).select("*", "v.*")
    counted = unfolded.groupBy(key, "kind", *slots).agg(
        F.sum(weight).alias("n"), *[F.sum(column).alias(f"sum_{column}") for column in sums]
    )
    alike = (
        (counted if dealt else counted.repartition(key))
        .groupBy(key, "kind", "n")
        .agg(
            *[F.min(slot).alias(slot) for slot in slots],
            *[F.sum(f"sum_{column}").alias(f"sum_{column}") for column in sums],
        )
    )

    def mode(name: str) -> Column:
        own = (F.col("kind") == name) & F.col(f"value_{name}").isNotNull()
        return F.max_by(f"value_{name}", F.when(own, F.col("n"))).alias(name)

    # Each row was unfolded once per column; the sums are taken from the first of them.
    first = F.col("kind") == names[0]
    return alike.groupBy(key).agg(
        *map(mode, names), *[F.sum(F.when(first, F.col(f"sum_{column}"))).alias(column) for column in sums]
    )


def latest_per_key(df: DataFrame, key: str, order: str, column: str, name: str) -> DataFrame:
    """Value of ``column`` on the row with the highest ``order`` per key, without a window."""
    return df.groupBy(key).agg(F.max_by(column, order).alias(name))


def item_sets(df: DataFrame, key: str, item: str, name: str) -> DataFrame:
    """Sorted distinct items per key as an array of strings."""
    items = F.array_sort(F.collect_set(F.col(item).cast("string")))
    return df.groupBy(key).agg(items.alias(name))


def min_items(df: DataFrame, column: str, least: int) -> DataFrame:
    return df.where(F.size(column) >= least)

"""Positions of rows within their groups, whatever the groups' sizes: ranges of the whole order, then prefix sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.llm.shared import free_names, stored

_ROW = (1 << 33) - 1


def matched(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of both sides, nulls equal to nulls; the left side's stay."""
    others = dict(zip(names, free_names(left, *[f"{name}_right" for name in names])))
    alike = [F.col(name).eqNullSafe(F.col(other)) for name, other in others.items()]
    return left.join(right.withColumnsRenamed(others), reduce(Column.__and__, alike), how).drop(*others.values())


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """All rows with their position from 0 among the rows of their group, and the number of these.

    Rows are sorted by ranges of (group, order), so a group of any size is spread over many tasks;
    only one count per range and group is added up in a window. Nulls come first. Rows that are equal
    in ``order`` take neighbouring positions in the order in which they are read.
    """
    tie, place, part = free_names(df, "tie", "place", "part")
    keys = [F.col(name).asc_nulls_first() for name in (*group, *order)] + [F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = dealt.sortWithinPartitions(*keys).drop(tie).withColumn(place, F.monotonically_increasing_id())
    placed = stored(
        placed.withColumns({part: F.shiftright(place, 33), place: F.col(place).bitwiseAND(_ROW)}), "placed"
    )
    pieces = placed.groupBy(part, *group).agg(F.min(place).alias("low"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumns(
        {"shift": F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low"), "whole": F.sum("n").over(whole)}
    )
    low, whole = free_names(placed, "shift", "whole")
    pieces = pieces.select(part, *group, F.col("shift").alias(low), F.col("whole").alias(whole))
    found = matched(placed, pieces, [part, *group])
    return found.select(*df.columns, (F.col(place) + F.col(low)).alias(rank), F.col(whole).alias(total))

"""Exact order statistics of a column, whatever the number of its values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rank error of the sketch, as a share of the rows.
ERROR = 1e-4


def exact_quantile(df: DataFrame, column: str, share: float, error: float = ERROR) -> Column:
    """The smallest value that at least ``share`` of the values do not exceed, as one value for any expression.

    A sketch with a bounded rank error gives two values between which the wanted rank lies. What is
    smaller is only counted; the few values between them are counted one by one and added up in
    order. So the sketch decides how much is sorted, never the result. Nulls are left out;
    without any value the result is null.
    """
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    accuracy = round(1 / error)

    def near(at: float) -> Column:
        return F.percentile_approx("value", min(max(at, 0.0), 1.0), accuracy)

    bounds = values.agg(
        F.struct(
            near(share - 3 * error).alias("low"), near(share + 3 * error).alias("high"), F.count(F.lit(1)).alias("n")
        )
    ).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    wanted = F.greatest(F.ceil(F.lit(share) * bounds.getField("n")), F.lit(1))
    below = values.agg(F.count_if(F.col("value") < low)).scalar()
    between = values.where((F.col("value") >= low) & (F.col("value") <= high))
    counts = between.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    # Rows: the distinct values within six errors, less than one of a thousand.
    upto = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select("value", (F.sum("n").over(upto) + below).alias("rank"))
    return ranked.where(F.col("rank") >= wanted).agg(F.min("value")).scalar()


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> Column:
    """Several of them as one struct: name -> (column, share)."""
    return F.struct(*[exact_quantile(df, column, share).alias(name) for name, (column, share) in wanted.items()])


def quantile_table(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """(column_name, share, value as a double): one row per column and share."""
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.lit(share).alias("share"),
            exact_quantile(df, column, share).cast("double").alias("value"),
        )
        for column in columns
        for share in shares
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))

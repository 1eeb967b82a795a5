"""Table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cartloom.functions.labels import percent
from cartloom.sources.schema import VIEW_NAMES, Tables


def table_summary(tables: Tables) -> DataFrame:
    """Row and column count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(VIEW_NAMES[name]).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])


def describe_cols(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum, one column per input column."""
    return df.select(*columns).describe()


def describe_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """The same statistics as numbers, one row per input column."""
    statistics = {
        "n": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    # All statistics come from one pass; the single row is then unfolded.
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    *[F.round(make(F.col(name)), digits).alias(s) for s, make in statistics.items()],
                )
                for name in columns
            ]
        ).alias("all")
    )
    return row.select(F.inline("all"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.withColumn("pct_of_total", percent(F.col("row_count"), total))

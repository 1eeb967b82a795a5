"""Writing results and reading written tables back."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for small report tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(rows: DataFrame, path: str) -> None:
    """Metric rows as one JSON-lines file."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """A fitted model or pipeline, replacing an older one."""
    model.write().overwrite().save(path)


def validate_outputs(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows and columns of each written table; a missing table has a null count and its error."""
    schema = "table_name string, row_count bigint, column_count int, error string"
    report = spark.createDataFrame([], schema)
    for name, path in paths.items():
        try:
            table = spark.read.parquet(path)
            count, width, error = table.agg(F.count(F.lit(1)).alias("n")), len(table.columns), None
        except AnalysisException as problem:
            count, width, error = spark.range(1).select(F.lit(None).alias("n")), None, problem
        report = report.unionByName(
            count.select(
                F.lit(name).alias("table_name"),
                F.col("n").cast("bigint").alias("row_count"),
                F.lit(width).cast("int").alias("column_count"),
                F.lit(None if error is None else error.getCondition()).cast("string").alias("error"),
            )
        )
    return report


@dataclass
class Report:
    """What a model task says about itself: inputs, one entry per run, and the run it chose."""

    task: str
    inputs: dict
    runs: list[dict] = field(default_factory=list)
    choice: dict | None = None
    skipped: str | None = None

    def skip(self, reason: str) -> "Report":
        self.skipped = reason
        return self

    def choose(self, measure: str, run: dict) -> "Report":
        self.choice = {"by": measure, **run}
        return self

    def as_dict(self) -> dict:
        return asdict(self)

"""Reading the six source files, registering views, sampling users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.functions.hashing import user_bucket
from cartloom.sources.schema import CSV_FILES, SCHEMAS, VIEW_NAMES, Tables

# Quotes inside quoted fields are doubled, and names may hold line breaks.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}

# Only free text can hold line breaks. The other files stay splittable, so that a large fact
# file is read by many tasks.
_FREE_TEXT = {"products", "aisles", "departments"}


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one CSV file, from any file system Spark can reach, with its fixed schema."""
    multi_line = "true" if name in _FREE_TEXT else "false"
    return (
        spark.read.schema(SCHEMAS[name])
        .options(**CSV_OPTIONS, multiLine=multi_line)
        .csv(f"{base.rstrip('/')}/{CSV_FILES[name]}")
    )


def load_tables(spark: SparkSession, base: str) -> Tables:
    """All six files as one bundle; raises once, naming every file that is missing."""
    frames: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name in CSV_FILES:
        try:
            frames[name] = read_table(spark, base, name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(CSV_FILES[name])
    if missing:
        raise FileNotFoundError(f"missing under {base}: {', '.join(missing)}")
    return Tables(op_all=frames["op_prior"].unionByName(frames["op_train"]), **frames)


def register_views(tables: Tables) -> None:
    """Make the tables reachable from ``spark.sql`` under the usual names.

    The days column of the orders is there under its short name, too.
    """
    for name, df in tables.items():
        if name == "orders":
            df = df.withColumn("days_since_prior", F.col("days_since_prior_order"))
        df.createOrReplaceTempView(VIEW_NAMES[name])


def write_csv_tables(tables: Tables, base: str, names: Iterable[str] = tuple(CSV_FILES)) -> None:
    """Write the six tables, or some, in the form ``load_tables`` reads, each as a folder of CSV files."""
    for name in names:
        writer = getattr(tables, name).write.mode("overwrite")
        writer.options(header="true", quote='"', escape='"').csv(f"{base.rstrip('/')}/{CSV_FILES[name]}")


def sample_users(tables: Tables, fraction: float, seed: int = 42) -> Tables:
    """Keep a share of the users with all of their orders and lines.

    The choice is a hash of the user id, so it needs no shuffle of users, is the same on every
    run and does not depend on how the data is partitioned. Sizes are measured anew.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"a share of the users is above 0 and at most 1, not {fraction}")
    if fraction == 1:
        return tables
    orders = tables.orders.where(user_bucket("user_id", f"sample:{seed}") < int(fraction * 65536))
    ids = orders.select("order_id")

    def keep(lines: DataFrame) -> DataFrame:
        return lines.join(ids, "order_id", "left_semi")

    return Tables(
        orders=orders,
        op_prior=keep(tables.op_prior),
        op_train=keep(tables.op_train),
        op_all=keep(tables.op_all),
        products=tables.products,
        aisles=tables.aisles,
        departments=tables.departments,
    )

"""Session and inputs of the command-line jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartloom.sources import staging
from cartloom.sources.readers import load_tables, sample_users
from cartloom.sources.schema import CSV_FILES, Tables

# One shuffle partition per this many input bytes; Spark merges the ones that stay small.
BYTES_PER_PARTITION = 128 * 1024 * 1024


def open_session(name: str) -> SparkSession:
    """The running session, or a new one with the settings the jobs rely on."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    return (
        SparkSession.builder.appName(name)
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def open_tables(spark: SparkSession, data: str, fraction: float = 1.0, seed: int = 42) -> Tables:
    """Load (a sample of) the CSV files, size the shuffles by them and store them by order."""
    paths = [f"{data.rstrip('/')}/{file}" for file in CSV_FILES.values()]
    tables = sample_users(load_tables(spark, data), fraction, seed)
    size, _ = staging.input_state(spark, paths)
    if "spark.sql.shuffle.partitions" not in dict(spark.sparkContext.getConf().getAll()):
        least = spark.sparkContext.defaultParallelism
        partitions = max(least, -(-size // BYTES_PER_PARTITION))
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return staging.store_tables(spark, tables, size)

"""Keeping basket tables on storage every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from cartloom.sources.schema import Tables, conform

# One bucket per this many input bytes, so that groupings in place of a bucket of any of the tables
# keep to a small part of a task's memory.
BYTES_PER_BUCKET = 4 * 1024 * 1024

# From this many buckets on they grow, up to LARGE_BUCKET bytes each; then their number does again.
MANY_BUCKETS = 20_480
LARGE_BUCKET = 512 * 1024 * 1024

# So many input files are listed by the driver itself, without a job.
FEW_FILES = 256

# Databases made for staged tables, by application.
_made: dict[str, list[str]] = {}

# A derived table may read another one while it is written.
_writing = threading.RLock()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named in ``spark.checkpoint.dir``.

    Where the setting is absent a single-process local session gets a folder of its own, removed
    when the program ends; on a cluster there is no safe guess, so the answer is None.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if context.master == "local" or context.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="cartloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        return folder
    return None


def required_folder(spark: SparkSession) -> str:
    """The shared folder, for work that cannot do without one."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def _listed(spark: SparkSession, paths: list[str], most: int) -> tuple[int, tuple] | None:
    """The state of a few files in a few folders, asked of their file system; None if there are more than ``most``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total, marks, left = 0, [], [jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    while left:
        path = left.pop()
        for file in path.getFileSystem(conf).listStatus(path):
            if len(marks) + len(left) > most:
                return None
            if file.isDirectory():
                left.append(file.getPath())
                continue
            total += file.getLen()
            marks.append((str(file.getPath()), file.getLen(), file.getModificationTime()))
    return total, (tuple(paths), *sorted(marks))


def input_state(spark: SparkSession, paths: list[str], few: int = FEW_FILES) -> tuple[int, tuple]:
    """Total bytes and a change marker over every file (path, length, time) of files or folders.

    Few files are listed by the driver, more by a Spark job; their content is not read. A part
    replaced in place changes the marker even if its length stays.
    """
    if (state := _listed(spark, paths, few)) is not None:
        return state
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    file = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    found = files.select("length", file.alias("file")).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.sum(F.col("file").cast("decimal(38,0)"))
    )
    count, total, mark = found.first()
    return total, (tuple(paths), count, total, mark)


def bucket_count(spark: SparkSession, input_bytes: int) -> int:
    """Buckets grow with the data, with at least one per core and at most as many as Spark allows.

    Beyond that limit they hold more bytes each; a bucket's sort and joins spill.
    """
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    small = min(-(-input_bytes // BYTES_PER_BUCKET), MANY_BUCKETS)
    return min(most, max(small, -(-input_bytes // LARGE_BUCKET), spark.sparkContext.defaultParallelism))


def remembered(
    tables: Tables, name: str, plan: Callable[[], DataFrame], key: str | None = None
) -> DataFrame:
    """A derived table, written once per input and read by every later plan.

    It goes to the database of the staged tables, else to the shared folder. Without a shared
    folder it stays a lazy plan. Every attempt writes to a place of its own and is known only when it is
    whole, so a failed one can be repeated; plans that run at the same time write it once.
    In a database a ``key`` deals the rows out to buckets, so groupings and joins by it need no shuffle.
    """
    spark = tables.orders.sparkSession
    with _writing:
        if name not in tables.known:
            mark = uuid.uuid4().hex[:12]
            if database := tables.known.get("database"):
                table = f"{database}.{name.replace('-', '_')}_{mark}"
                _writer(plan(), tables.known.get("buckets", 1), key).saveAsTable(table)
                tables.known[name] = table
            elif folder := shared_folder(spark):
                df, path = plan(), f"{folder}/{name}-{mark}"
                df.write.parquet(path)
                tables.known[name] = (path, df.schema)
            else:
                return plan()
    place = tables.known[name]
    return spark.table(place) if isinstance(place, str) else spark.read.schema(place[1]).parquet(place[0])


def _writer(df: DataFrame, buckets: int, key: str | None) -> DataFrameWriter:
    """A Parquet writer, of buckets by ``key`` if there is one."""
    if key is None:
        return df.write.format("parquet")
    return df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)


@dataclass
class Store:
    """A database of its own in the shared folder, for one set of basket tables."""

    spark: SparkSession
    database: str
    buckets: int
    where: dict = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, folder: str, input_bytes: int) -> "Store":
        database = f"cartloom_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/{database}'")
        _made.setdefault(spark.sparkContext.applicationId, []).append(database)
        buckets = bucket_count(spark, input_bytes)
        return cls(spark, database, buckets, {"known": {"database": database, "buckets": buckets}})

    def _saved(self, name: str, writer) -> DataFrame:
        self.where[name] = f"{self.database}.{name}"
        writer.mode("overwrite").saveAsTable(self.where[name])
        return self.spark.table(self.where[name])

    def plain(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table as Parquet and return a scan of it."""
        return self._saved(name, _writer(df, self.buckets, None))

    def by_order(self, name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        """Write a table bucketed by order: later joins and groupings by order need no shuffle."""
        writer = _writer(df, self.buckets, "order_id")
        return self._saved(name, writer.partitionBy(partition) if partition else writer)


def drop_stores(spark: SparkSession) -> None:
    """Drop the staged tables of this application, files included."""
    for database in _made.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@atexit.register
def _drop_at_exit() -> None:
    session = SparkSession.getActiveSession() if SparkContext._active_spark_context else None
    if session is not None:
        drop_stores(session)


def bundle(
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    known: dict | None = None,
) -> Tables:
    """The table bundle where one line table with an ``eval_set`` column holds all lines."""

    def of_set(name: str) -> DataFrame:
        return lines.where(F.col("eval_set") == name).drop("eval_set")

    return Tables(
        orders=orders,
        op_prior=of_set("prior"),
        op_train=of_set("train"),
        op_all=lines.drop("eval_set"),
        products=products,
        aisles=aisles,
        departments=departments,
        known={} if known is None else known,
    )


def scan(spark: SparkSession, where: dict) -> Tables:
    """Scans of a stored set of tables; lines of one set are read from their own partition."""

    return bundle(
        spark.table(where["orders"]),
        spark.table(where["lines"]),
        spark.table(where["products"]),
        spark.table(where["aisles"]),
        spark.table(where["departments"]),
        where["known"],
    )


def store_tables(spark: SparkSession, tables: Tables, input_bytes: int) -> Tables:
    """Convert loaded tables once, from text files to columns bucketed by order.

    Without a shared folder the tables are returned as they are.
    """
    folder = shared_folder(spark)
    if folder is None:
        return tables
    store = Store.open(spark, folder, input_bytes)
    for name in ("products", "aisles", "departments"):
        store.plain(name, conform(getattr(tables, name), name))
    store.by_order("orders", conform(tables.orders, "orders"))
    lines = [
        conform(getattr(tables, f"op_{name}"), "op_prior").withColumn("eval_set", F.lit(name))
        for name in ("prior", "train")
    ]
    store.by_order("lines", lines[0].unionByName(lines[1]), partition="eval_set")
    return scan(spark, store.where)

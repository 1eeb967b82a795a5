"""Helpers shared by the operators: tables, the shared work folder, Arrow batches, a bounded cache."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of characters that are not ASCII white space. ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a Python task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder. Python workers of sessions started elsewhere learn where this package is."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


_OWN_FOLDERS: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a local session without one gets its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = context.applicationId
    if key not in _OWN_FOLDERS:
        _OWN_FOLDERS[key] = tempfile.mkdtemp(prefix="cartloom-llm-")
    return _OWN_FOLDERS[key]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a relation to the shared folder and read it again: lost executors cost no recomputation."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by the hash of a key; all rows where there are no more."""
    step = -(-df.count() // bound)
    if step <= 1:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(step)) == 0)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The columns that do not have one of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{column}`") for column in df.columns if column.lower() not in taken])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def word_count(text: Column) -> Column:
    """Words of a text, null counting as empty, without a copy of each word.

    ``\\S`` is what ``WORD`` repeats, in a form that Java tests faster.
    """
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S++")).cast("long")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of every value; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def as_text(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named text column of each part has about ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            if held and held + length > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        yield batch.slice(start)


class Memo(dict):
    """Results by key in two generations: a full young one becomes the old one, which is forgotten next."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

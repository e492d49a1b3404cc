"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.storage import scratch_dir

#: A word in the contracts of the word-based operators: whatever ASCII white space separates.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` written as a table in the shared folder, in a folder per value of ``by``, and read back.

    Lineage ends here, so a lost executor repeats nothing from before.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Send whole texts to Python workers in smaller Arrow batches than the default 10,000 rows and 64 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def key_crc(key: Column | str) -> Column:
    """crc32 of a key written as text; a null key counts as empty text."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def binary_array(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.large_binary() if sum(map(len, blobs)) > 2**31 - 1 else pa.binary())


def int_lists(packed: list[bytes]) -> pa.Array:
    """A list array of int32 from little-endian packed values."""
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)])
    values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which its owner sets by the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[Column], out: str, label: str) -> tuple[DataFrame, int]:
    """Every row with its number from 0 in the given order as column ``out``, and the number of rows.

    Rows are dealt by ranges of the order and numbered within each; what goes through one task is a row per range, of
    which there are as many as the session's shuffle width. Rows that tie are dealt over tasks too, in any order.
    """
    tie = df.withColumn("__tie", F.monotonically_increasing_id())
    ranges = tie.repartitionByRange(partitions(df.sparkSession), *order, F.col("__tie")).sortWithinPartitions(*order, "__tie")
    placed = stored(ranges.drop("__tie").withColumn("__at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("__part", F.shiftright("__at", 33))  # the task's number, the row's number in it below
    counts = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    number = F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(starts), "__part").withColumn(out, number).drop("__at", "__part", "__start"), placed.count()


@contextmanager
def no_collector():
    """Keep the cycle collector from walking over large memories again and again; nothing in them forms cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_KEPT: dict = {}


def kept(key, build):
    """An object that a Python worker keeps for later tasks. Only the latest is kept, as workers serve all operators."""
    if key not in _KEPT:
        drop_kept()
        _KEPT[key] = build()
    return _KEPT[key]


def drop_kept() -> None:
    """Let go of what the worker keeps. Functions sent to workers call this; a reference of theirs to the dict is a copy."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Return a worker's free memory to the system, which allocators otherwise hold for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def tidy(batches):
    """The batches that a worker makes; its free memory is given back behind the last."""
    yield from batches
    give_back()


def tidied(body):
    """For a function of batches that keeps nothing: what other operators kept goes, and memory is given back at its end."""

    @wraps(body)
    def run(batches):
        drop_kept()
        return tidy(body(batches))

    return run


def pieces_of(texts: pa.Array, size: int) -> list[pa.Array]:
    """A batch of texts in slices of some ``size`` bytes."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(total)) + 1).tolist(), len(texts)]
    return [texts[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

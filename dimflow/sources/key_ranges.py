"""Key ranges of a Parquet table's files, so that an upsert reads only files that may hold an incoming key."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimflow import storage
from dimflow.functions.predicates import all_present
from dimflow.sources.tables import read_table

_FILE = "_metadata.file_path"


def _key(keys: Sequence[str]) -> Column:
    """The key as a struct, which compares column by column; null unless all columns are present."""
    return F.when(all_present(keys), F.struct(*keys))


def index_files(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(file, low, high) of every file under ``path`` that has rows, kept beside the table.

    The ranges lie in ``path/_key_ranges``, which readers of the table skip and an overwrite of it removes. Files are
    never changed once written, so only those without an entry are scanned, and only their key columns; entries of
    files that are gone stay and match nothing. Runs that overlap may both add a file: its range is the same.
    ``low`` and ``high`` are null for a file without a usable key.
    """
    folder = f"{path}/_key_ranges/{quote('+'.join(keys), safe='+')}"
    table = spark.read.parquet(path)

    def ranges(rows: DataFrame) -> DataFrame:
        found = rows.select(F.col(_FILE).alias("file"), _key(keys).alias("key"))
        return found.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))

    schema = ranges(table).schema
    known = read_table(spark, "parquet", {"path": folder}, schema=schema, missing_ok=True)
    seen = {row.file for row in known.select("file").collect()}  # a name per file
    there = table.select(F.col(_FILE).alias("file")).distinct()  # reads no column
    new = [row.file for row in there.collect() if row.file not in seen]
    if new:
        ranges(table.where(F.col(_FILE).isin(new)) if seen else table).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def key_intervals(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(first, last) of the incoming keys, a row for each of as many ranges as the session's shuffle width."""
    width = int(incoming.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = incoming.where(all_present(keys)).select(*keys).repartitionByRange(width, *keys)
    part = dealt.groupBy(F.spark_partition_id().alias("part"))
    return part.agg(F.min(_key(keys)).alias("first"), F.max(_key(keys)).alias("last")).select("first", "last")


def files_holding(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files under ``path`` whose key range meets one of the incoming keys' intervals.

    Intervals are broadcast, as there are never more than the session's shuffle width.
    """
    files = index_files(spark, path, keys)
    meets = (F.col("first") <= F.col("high")) & (F.col("last") >= F.col("low"))
    met = files.join(F.broadcast(key_intervals(incoming, keys)), meets, "left_semi")
    return sorted({row.file for row in met.select("file").collect()})  # a name per file


def rows_of_files(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table at ``path`` without the files that cannot hold an incoming key; no rows if there is no table yet."""
    if not storage.list_names(spark, path):
        return incoming.limit(0)
    files = files_holding(spark, path, incoming, keys)
    return spark.read.schema(incoming.schema).parquet(path).where(F.col(_FILE).isin(files))

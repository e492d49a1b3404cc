"""Readers and writers for files and warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dimflow import storage


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, infer: bool = False, **options: str
) -> DataFrame:
    """CSV with a header row: declared types, or all strings, or inferred with ``infer``.

    Inference reads the files once more, and turns codes such as zip into numbers.
    """
    reader = spark.read.option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """JSON Lines, or with ``multi_line`` documents holding an array of records.

    A multi-line document cannot be split, so large inputs should be JSON Lines.
    """
    reader = spark.read.option("multiLine", multi_line).options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_table(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    schema: StructType | None = None,
    missing_ok: bool = False,
) -> DataFrame:
    """Any Spark source by format and options: files, JDBC, or a vendor connector.

    With ``missing_ok`` a path that does not exist yet reads as an empty table.
    """
    if missing_ok and not storage.exists(spark, options["path"]):
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def write_table(
    df: DataFrame, fmt: str, options: Mapping[str, str], mode: str = "append", partition_by: Sequence[str] = ()
) -> None:
    """Append to or overwrite a table of any Spark sink format."""
    writer = df.write.format(fmt).options(**options).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save()


def compact(df: DataFrame, *partition_by: str) -> DataFrame:
    """Let AQE size the output files: a small result becomes one file, a large one many.

    With ``partition_by`` rows of one table partition are brought together first; a
    partition much larger than others is split again, so none is left to one task.
    """
    return df.hint("rebalance", *(F.col(c) for c in partition_by))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every part file, written by all tasks."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = False) -> bool:
    """Parquet directory; returns False when ``skip_empty`` found nothing to write."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode(mode).parquet(path)
    return True

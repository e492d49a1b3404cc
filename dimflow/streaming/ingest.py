"""File-arrival processing with Structured Streaming.

Each run takes the files that arrived since the last one, exactly once per file, and
stops. Late restarts and lost executors are covered by the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StructType

from dimflow.functions.rules import UniqueRule, rule_names
from dimflow.operators.quality import Rules, validate


_FILE = "__file"


def file_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    fmt: str = "csv",
    archive_dir: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of the files under ``source_dir``.

    With ``archive_dir`` a file is moved there after its batch is committed, by the
    batch that follows. ``files_per_batch`` bounds the size of one batch.
    """
    reader: DataStreamReader = spark.readStream.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(source_dir)


def ingest_stream(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append all newly arrived rows to a Parquet table, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def validate_stream(stream: DataFrame, rules: Rules, target: str, checkpoint: str) -> StreamingQuery:
    """Validate newly arrived rows and write them under ``batch_id=/outcome=``, then stop.

    Uniqueness rules compare rows of the same file, however files are dealt into batches. A
    repeated batch replaces its own output, so a restart neither loses nor doubles rows.
    """
    rules = [UniqueRule(r.name, (*r.keys, _FILE)) if isinstance(r, UniqueRule) else r for r in rules]
    columns = stream.columns
    stream = stream.withColumn(_FILE, F.col("_metadata.file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        outcome = F.when(F.col("is_valid"), "valid").otherwise("quarantine")
        (
            validate(batch, rules)
            .select(*columns, *rule_names(rules), outcome.alias("outcome"))
            .write.mode("overwrite")
            .partitionBy("outcome")
            .parquet(f"{target}/batch_id={batch_id}")
        )

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

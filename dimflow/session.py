"""Spark session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


# Shuffle bytes per task to aim for before AQE merges small partitions.
PARTITION_BYTES = 256 * 1024**2


def initial_partitions(input_bytes: int, slots: int) -> int:
    """Shuffle partitions to start from: enough that one fits a task's memory, and every slot gets work."""
    return max(slots, -(-input_bytes // PARTITION_BYTES))


def get_session(app_name: str = "dimflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; ``conf`` keys use ``__`` in place of dots.

    On a cluster set ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` to
    ``initial_partitions`` of the input: AQE merges partitions but does not add any.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

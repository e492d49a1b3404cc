"""High-water-mark extracts and their audit trail."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, TimestampType

from dimflow import storage
from dimflow.functions.predicates import all_present
from dimflow.operators.dedup import dedup_by_key
from dimflow.schemas import AUDIT
from dimflow.sources.tables import compact, read_table, write_table


def high_water_mark(audit: DataFrame, job: str, as_type: DataType) -> Column | None:
    """The job's last watermark as a literal, or None when the job never ran.

    One value comes back to the driver. As a literal the filter on it is pushed down
    into Parquet and JDBC scans, so an increment does not read the whole source.
    """
    mark = audit.where(F.col("jobname") == job).agg(F.max("lastrundate").alias("mark"))
    if isinstance(as_type, TimestampType):
        micros = mark.select(F.unix_micros(F.col("mark").cast("timestamp"))).first()[0]
        return None if micros is None else F.timestamp_micros(F.lit(micros))
    text = mark.select(F.col("mark").cast(as_type).cast("string")).first()[0]
    return None if text is None else F.lit(text).cast(as_type)


def incremental_extract(source: DataFrame, audit: DataFrame, job: str, ts_col: str) -> DataFrame:
    """Rows newer than the job's last watermark; all rows on its first run."""
    mark = high_water_mark(audit, job, source.schema[ts_col].dataType)
    return source if mark is None else source.where(F.col(ts_col) > mark)


def audit_rows(loaded: DataFrame, job: str, run_id: str, ts_col: str) -> DataFrame:
    """The audit row for a finished load; none when nothing was loaded."""
    return (
        loaded.agg(F.max(ts_col).cast("timestamp").alias("lastrundate"))
        .where("lastrundate IS NOT NULL")
        .select(F.lit(job).alias("jobname"), F.lit(run_id).alias("runid"), "lastrundate")
    )


def keyed_increment(source: DataFrame, audit: DataFrame, job: str, ts_col: str, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows at or after the job's last watermark, and rows without a stamp, whose keys ``target`` lacks.

    So a row that arrives late with the stamp of the mark, or with none, is loaded once. One
    row per key is taken; rows without a key are not loaded.
    """
    mark = high_water_mark(audit, job, source.schema[ts_col].dataType)
    fresh = source if mark is None else source.where((F.col(ts_col) >= mark) | F.col(ts_col).isNull())
    return insert_ignore(target if target is not None else source.limit(0), fresh, keys)


def run_incremental(
    spark: SparkSession,
    source: DataFrame,
    audit_path: str,
    target_path: str,
    job: str,
    run_id: str,
    ts_col: str,
    compact_files: bool = False,
    keys: Sequence[str] = (),
) -> int:
    """Load the increment into ``target_path/run_id=<run_id>`` and record it; returns its row count.

    Without ``keys`` the increment is what is newer than the watermark; rows without a stamp
    cannot be told from loaded ones and are left out in every run. With ``keys`` it is
    :func:`keyed_increment`, which takes late rows as well. The watermark is the maximum over
    the rows written, or the one before if none had a stamp. The increment is computed once, on
    its way into a folder that readers do not see. A numbered commit file, which only one of several
    runs can create, then makes it the job's next load, and the folder and the audit row follow; a run
    that finds a commit without them, as its writer was lost, adds them first. A run that finds
    its number taken drops its output and starts again from the new watermark, so runs may overlap. A
    run that failed may be repeated; one already recorded writes nothing.
    """
    log = _CommitLog(spark, audit_path, target_path, job)
    while True:
        number = log.repair()
        audit = log.audit()
        if not audit.where((F.col("jobname") == job) & (F.col("runid") == run_id)).isEmpty():
            return 0
        if keys:
            loaded = spark.read.schema(source.schema).parquet(target_path) if storage.exists(spark, target_path) else None
            increment = keyed_increment(source, audit, job, ts_col, loaded, keys)
        else:
            increment = incremental_extract(source.where(F.col(ts_col).isNotNull()), audit, job, ts_col)
        # Directly under the write, the metrics count each written row once even if tasks are retried.
        written = Observation(f"{job}-{run_id}")
        observed = (compact(increment) if compact_files else increment).observe(
            written, F.count(F.lit(1)).alias("row_count"), F.max(ts_col).cast("timestamp").cast("string").alias("mark")
        )
        staged = f"_staged-{uuid.uuid4().hex}"
        try:
            write_table(observed, "parquet", {"path": f"{target_path}/{staged}"}, mode="overwrite")
        except Exception:
            storage.delete(spark, f"{target_path}/{staged}")
            raise
        rows, mark = written.get["row_count"], written.get["mark"]
        if log.commit(number + 1, {"run_id": run_id, "staged": staged, "rows": rows, "mark": mark}):
            log.repair()
            return rows
        storage.delete(spark, f"{target_path}/{staged}")


class _CommitLog:
    """The numbered loads of a job, one small file each."""

    def __init__(self, spark: SparkSession, audit_path: str, target_path: str, job: str):
        self.spark, self.audit_path, self.target_path, self.job = spark, audit_path, target_path, job
        self.folder = f"{audit_path}/_commits/{quote(job, safe='')}"  # readers of the audit skip it

    def audit(self) -> DataFrame:
        return read_table(self.spark, "parquet", {"path": self.audit_path}, schema=AUDIT, missing_ok=True)

    def commit(self, number: int, load: dict) -> bool:
        return storage.put_if_absent(self.spark, f"{self.folder}/{number:012d}", json.dumps(load))

    def repair(self) -> int:
        """Complete the last load, if its writer has not, and return its number; 0 without loads."""
        names = [n for n in storage.list_names(self.spark, self.folder) if n.isdigit()]
        if not names:
            return 0
        load = json.loads(storage.read_text(self.spark, f"{self.folder}/{names[-1]}"))
        staged, run_id = f"{self.target_path}/{load['staged']}", load["run_id"]
        if not load["rows"]:
            storage.delete(self.spark, staged)
        elif storage.exists(self.spark, staged) and not storage.exists(self.spark, f"{self.target_path}/run_id={run_id}"):
            storage.move(self.spark, staged, f"{self.target_path}/run_id={run_id}")
        audit = self.audit()
        if audit.where((F.col("jobname") == self.job) & (F.col("runid") == run_id)).isEmpty():
            _record(self.spark, audit, self.audit_path, self.job, run_id, load["mark"])
        return int(names[-1])


def _record(spark: SparkSession, audit: DataFrame, audit_path: str, job: str, run_id: str, mark: str | None) -> None:
    """Append the run's audit row; a run without stamps repeats the job's last mark."""
    before = audit.where(F.col("jobname") == job).agg(F.unix_micros(F.max("lastrundate"))).first()[0]
    last = F.greatest(F.lit(mark).cast("timestamp"), F.timestamp_micros(F.lit(before).cast("long")))
    row = spark.range(1, numPartitions=1).select(F.lit(job).alias("jobname"), F.lit(run_id).alias("runid"), last.alias("lastrundate"))
    write_table(row, "parquet", {"path": audit_path}, mode="append")


def insert_ignore(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ()
) -> DataFrame:
    """The incoming rows whose keys the target lacks, the first of each key.

    The target is reduced to the incoming keys it has before anything of it is shuffled for the
    anti join; where the incoming keys are few they are broadcast, and the target is only scanned.
    """
    first = dedup_by_key(incoming.where(all_present(keys)), keys, order_by)
    wanted = incoming.where(all_present(keys)).select(*keys).distinct()
    known = target.select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return first.join(known, list(keys), "left_anti").select(*incoming.columns)

"""Paths on the cluster's file system, reached through Hadoop's FileSystem API."""

from __future__ import annotations

import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when the directory is missing."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hpath))


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within one file system, creating the target's parent."""
    fs, src = _hadoop(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    return fs.rename(src, dst)


#: Schemes whose files tasks move themselves; others are reached through Hadoop's FileSystem on the driver only.
TASK_SCHEMES = ("file", "hdfs")
MOVED, MISSING = "moved", "missing"
JOURNAL = "path string, target string, state string"


def _split_uri(uri: str) -> tuple[str, str]:
    """Scheme (file without one) and the URI in the form that pyarrow takes."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return "file", uri
    return scheme, rest if scheme == "file" and not rest.startswith("//") else rest.removeprefix("//") if scheme == "file" else uri


def _move_in_task(source: str, target: str) -> str:
    """Move one file, or find it moved already."""
    import pyarrow.fs as fs

    (scheme, source), (_, target) = _split_uri(source), _split_uri(target)
    if scheme == "file":
        system = fs.LocalFileSystem()
    else:
        system, source = fs.FileSystem.from_uri(source)
        target = fs.FileSystem.from_uri(target)[1]
    folder, _, name = source.rpartition("/")
    into, _, new = target.rpartition("/")
    here, there = (info.type != fs.FileType.NotFound for info in system.get_file_info([source, target]))
    if here:
        system.create_dir(into, recursive=True)
        system.move(source, target)
        checksum = f"{folder}/.{name}.crc"  # Hadoop's, beside local files
        if scheme == "file" and system.get_file_info(checksum).type != fs.FileType.NotFound:
            system.move(checksum, f"{into}/.{new}.crc")
    return MOVED if here or there else MISSING


def move_files(moves: DataFrame) -> DataFrame:
    """Move files within one file system, a row (path, target) each; returns the journal (path, target, state), stored.

    Tasks move the files, so the work grows with the executors and none passes through the driver. A move may be repeated, after
    a lost executor or in another run: a file that is at its target and no longer at its path is "moved"; one that is at
    neither is "missing". File systems that tasks cannot reach without Hadoop are worked off on the driver.
    """
    spark = moves.sparkSession

    def work(batches):
        for batch in batches:
            paths, targets = (batch.column(i).to_pylist() for i in (0, 1))
            states = [_move_in_task(*pair) for pair in zip(paths, targets, strict=True)]
            yield pa.RecordBatch.from_pydict({"path": paths, "target": targets, "state": states})

    journal = scratch_dir(spark, "journal")
    own = F.coalesce(F.nullif(F.regexp_extract("path", "^([a-zA-Z][A-Za-z0-9+.-]*):", 1), F.lit("")), F.lit("file")).isin(*TASK_SCHEMES)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moves.where(own).repartition(width).mapInArrow(work, JOURNAL).write.parquet(journal)
    rest = []
    for row in moves.where(~own).collect():  # one row of metadata per file
        done = move(spark, row.path, row.target) or exists(spark, row.target)
        rest.append((row.path, row.target, MOVED if done else MISSING))
    if rest:
        spark.createDataFrame(rest, JOURNAL).write.mode("append").parquet(journal)
    return spark.read.schema(JOURNAL).parquet(journal)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, such as a commit."""
    fs, hpath = _hadoop(spark, path)
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists; of several writers one gets True. Readers see the whole text or no file.

    The text is written under another name, which then becomes ``path``: by a hard link on local file systems, else by a
    rename, which HDFS refuses if the target exists. On stores without atomic renames two writers may both win.
    """
    fs, hpath = _hadoop(spark, path)
    fs.mkdirs(hpath.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{hpath.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(hpath) and fs.rename(draft, hpath)
        local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (hpath, draft)]
        try:
            spark._jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass()):
                raise
            return False
        return True
    finally:
        fs.delete(draft, False)


def delete(spark: SparkSession, path: str) -> None:
    """Remove what this library wrote under ``path`` itself, such as the output of a run that lost."""
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting it lies in the session's warehouse, which executors must reach as well: on a cluster a warehouse on
    local disks is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        if _split_uri(shared)[0] == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"

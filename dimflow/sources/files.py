"""Working on many files: merging CSVs, converting drops to Parquet, archiving them."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dimflow import storage
from dimflow.schemas import MANIFEST
from dimflow.sources.json_arrays import infer_json, json_records
from dimflow.sources.tables import read_csv, read_json

LOADED, UNSUPPORTED, FAILED = "loaded", "unsupported", "failed"
CORRUPT = "_corrupt_record"
NAME = "source_file"
FORMATS = ("csv", "json")


def base_name(path: Column) -> Column:
    """File name without directory and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def list_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every file below ``directory``; contents stay unread."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory).select("path", "length", "modificationTime")


def _early_line_no() -> Column:
    """Rising numbers for the lines of a file's first block that are not blank, as readers skip blank lines."""
    return F.when((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""), F.monotonically_increasing_id())


def json_arrays(spark: SparkSession, directory: str) -> set[str]:
    """Paths, without scheme, of the JSON files below ``directory`` that hold one array, not a record per line."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .text(directory)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.ltrim("value").startswith("[").alias("opens"),
            _early_line_no().alias("line_no"),
        )
    )
    first = lines.groupBy("path").agg(F.min_by("opens", "line_no").alias("is_array")).where("is_array")
    return {_path_only(unquote(row.path)) for row in first.select("path").toLocalIterator()}


def csv_layouts(spark: SparkSession, directory: str) -> DataFrame:
    """(path, is_utf8, header) of every CSV below ``directory``; header is a hash of the first line that is not blank.

    Lines are checked where they are read and combined per file, so a large file is
    split over many tasks. A line break never occurs inside a UTF-8 character.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(directory)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.is_valid_utf8("value").alias("is_utf8"),
            F.xxhash64("value").alias("line"),
            _early_line_no().alias("line_no"),
        )
    )
    return lines.groupBy("path").agg(
        F.bool_and("is_utf8").alias("is_utf8"), F.min_by("line", "line_no").alias("header")
    )


def merge_csv(spark: SparkSession, directory: str) -> DataFrame:
    """All CSV files below ``directory`` as one DataFrame of strings.

    Files that are not valid UTF-8 are read as Latin-1. Columns are matched by name;
    a file that lacks a column yields NULL for it. Files that agree on encoding and
    header are read together, so the plan grows with the number of layouts, not files.
    """
    layouts: dict[tuple[bool, int], list[str]] = defaultdict(list)
    for row in csv_layouts(spark, directory).orderBy("path").toLocalIterator():
        layouts[row.is_utf8, row.header].append(_exact(unquote(row.path)))  # _metadata paths are URL-encoded
    if not layouts:
        raise FileNotFoundError(f"no CSV files below {directory}")
    parts = [
        read_csv(spark, paths, encoding="UTF-8" if is_utf8 else "ISO-8859-1")
        for (is_utf8, _), paths in layouts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _exact(path: str) -> str:
    """``path`` as a read argument that matches only itself, not a glob."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


@dataclass
class Layout:
    """Files that are read and written together; ``schema`` is the declared one, if any."""

    format: str
    is_array: bool
    schema: StructType | None
    target: str
    files: dict[str, str]  # paths by base name


@dataclass
class Loaded:
    """What became of a file: its rows, its malformed records, where the rows are, or why it failed."""

    rows: int = 0
    bad: int = 0
    target: str | None = None
    error: str | None = None


def _first_keys(spark: SparkSession, directory: str) -> DataFrame:
    """(path, keys) of every JSON file below ``directory``: the keys of the record on its first line that is not blank."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(directory)
    keys = F.array_join(F.array_sort(F.json_object_keys("value")), "\n")
    first = lines.select(F.col("_metadata.file_path").alias("path"), keys.alias("keys"), _early_line_no().alias("line_no"))
    return first.groupBy("path").agg(F.min_by("keys", "line_no").alias("keys"))


def _layouts(spark: SparkSession, listed: list, source_dir: str, target_dir: str, schemas: Mapping[str, StructType]) -> list[Layout]:
    """The files (path, ext, name) by layout: those of one declared schema, and those that start alike."""
    arrays = json_arrays(spark, source_dir) if any(f.ext == "json" for f in listed) else set()
    starts: dict[str, str] = {}
    for ext, found, column in (("csv", csv_layouts, "header"), ("json", _first_keys, "keys")):
        if any(f.ext == ext and f.name not in schemas for f in listed):
            rows = found(spark, source_dir).select("path", F.col(column).cast("string").alias("start"))
            starts |= {_path_only(unquote(r.path)): r.start for r in rows.toLocalIterator()}
    layouts: dict[tuple, Layout] = {}
    for f in listed:
        path = _path_only(f.path)
        schema, is_array = schemas.get(f.name), path in arrays
        if schema is not None:
            start = schema.json()
        else:
            start = "" if is_array else starts.get(path) or path  # a file without a readable start is alone
        key = (f.ext, is_array, schema is not None, start)
        if key not in layouts:
            digest = hashlib.sha256(repr(key).encode()).hexdigest()[:12]
            layouts[key] = Layout(f.ext, is_array, schema, f"{target_dir}/{f.ext}-{digest}", {})
        layouts[key].files[f.name] = f.path
    return list(layouts.values())


def _plain_name(path: str) -> Column:
    """Base name from a URL-encoded path, in which a plus stands for itself."""
    return base_name(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))))


def _rows(spark: SparkSession, layout: Layout, mode: str) -> tuple[DataFrame, str]:
    """The rows of a layout, and the name of the column that holds their file's base name.

    With PERMISSIVE a malformed record is kept in ``CORRUPT``.
    """
    paths = [_exact(path) for path in layout.files.values()]
    if layout.is_array:
        records = json_records(spark, paths).select(_plain_name("file").alias("name"), "record")
        kept = storage.scratch_dir(spark, "records")
        records.write.parquet(kept)
        records = spark.read.schema(records.schema).parquet(kept)
        schema = layout.schema or infer_json(spark, records)
    elif layout.format == "csv":
        schema = layout.schema or read_csv(spark, paths[0]).schema  # the header is that of all
    else:
        schema = layout.schema or read_json(spark, paths).schema
    if schema.names == [CORRUPT] or not schema.names:
        raise ValueError("no record can be read")
    name = NAME
    while name in map(str.lower, schema.names):
        name = f"_{name}"
    if mode == "PERMISSIVE" and CORRUPT not in schema.names and (layout.schema is not None or layout.format == "csv"):
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    if layout.is_array:
        row = F.from_json("record", schema, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})
        return records.select(F.col("name").alias(name), row.alias("row")).select(name, "row.*"), name
    rows = read_csv(spark, paths, schema, mode=mode) if layout.format == "csv" else read_json(spark, paths, schema, mode=mode)
    return rows.withColumn(name, _plain_name("_metadata.file_path")), name


def _load(spark: SparkSession, layout: Layout, mode: str) -> dict[str, Loaded]:
    """Write a layout's files together, each to a partition of its own.

    If the job fails for malformed records, the files that hold some are found and the others written again.
    """
    try:
        rows, name = _rows(spark, layout, mode)
    except (AnalysisException, ValueError) as error:
        return {file: Loaded(error=str(error)) for file in layout.files}
    result = {file: Loaded() for file in layout.files}

    def write(rows: DataFrame) -> int:
        counted = Observation()
        bad = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None)
        seen = rows.observe(counted, F.count(bad).alias("bad"))
        clean = seen if layout.schema is None and layout.format == "json" else seen.drop(CORRUPT)
        writer = clean.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name)
        writer.parquet(layout.target)
        return counted.get["bad"]

    def malformed(rows: DataFrame) -> dict[str, int]:
        values = F.to_json(F.struct(*[c for c in rows.columns if c not in (CORRUPT, name)]))
        found = rows.groupBy(name).agg(F.count(CORRUPT).alias("bad"), F.max(F.length(values)))  # so that all columns are parsed
        return {r[0]: r.bad for r in found.filter("bad > 0").toLocalIterator()}

    try:
        if write(rows):
            for file, bad in malformed(rows).items():
                result[file].bad = bad
    except (Py4JJavaError, SparkRuntimeException) as error:
        if "MALFORMED" not in str(error):
            raise  # lost executors and full disks are no fault of a file
        rows, name = _rows(spark, layout, "PERMISSIVE")
        broken = malformed(rows)
        for file, bad in broken.items():
            result[file].error = f"{bad} malformed records"
        write(rows.where(~F.col(name).isin(list(broken))))
    written = spark.read.schema(StructType([StructField(name, StringType())])).parquet(layout.target)
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    for r in written.groupBy(name).agg(F.count("*").alias("rows"), F.min(folder).alias("folder")).toLocalIterator():
        if r[0] in result and not result[r[0]].error:
            result[r[0]].rows, result[r[0]].target = r.rows, unquote(r.folder)
    return result


def convert_to_parquet(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    schemas: Mapping[str, StructType] | None = None,
    mode: str = "PERMISSIVE",
    parallel_jobs: int = 4,
) -> DataFrame:
    """Write the CSV and JSON files below ``source_dir`` as Parquet, each file's rows as a partition of its layout's table.

    Returns the manifest: one row per file with its status, row count and ``target``, the folder of its rows (none if it has
    no rows). Files of one layout are read and written by one job, so jobs grow with the layouts, not with the files. A layout
    is ``target_dir/<format>-<digest>``; its partition column is ``source_file``, the base name. ``schemas`` declares types by base
    name; other files are together if their headers (all columns strings) or the keys of their first records are the same; JSON
    arrays without a schema are one layout, and large ones are split over tasks. Converting a file again replaces its
    partition. Files of other types are "unsupported"; files that share a name are "failed", as is a file in which no
    record can be read. ``mode`` is Spark's handling of malformed records: "FAILFAST" fails the files that hold one, and
    only those; else their number is in the manifest's ``error``. Errors that are no fault of a file end the call.
    """
    schemas = schemas or {}
    files = list_files(spark, source_dir).select(
        "path", "length", extension(F.col("path")).alias("ext"), base_name(F.col("path")).alias("name")
    )
    listed = sorted(files.collect())  # one row of metadata per file
    claims = Counter(f.name for f in listed if f.ext in FORMATS)
    own = [f for f in listed if f.ext in FORMATS and claims[f.name] == 1]
    layouts = _layouts(spark, own, source_dir, target_dir, schemas)
    with ThreadPool(parallel_jobs) as pool:
        found = pool.map(lambda layout: _load(spark, layout, mode), layouts, chunksize=1)
    loaded = {name: result for results in found for name, result in results.items()}

    def outcome(f) -> tuple:
        if f.ext not in FORMATS:
            return f.path, f.ext, None, UNSUPPORTED, None, f.length, None
        if claims[f.name] > 1:
            return f.path, f.ext, None, FAILED, None, f.length, f"{claims[f.name]} files share the name {f.name}"
        result = loaded[f.name]
        if result.error:
            return f.path, f.ext, None, FAILED, None, f.length, result.error
        error = f"{result.bad} malformed records" if result.bad else None
        return f.path, f.ext, result.target, LOADED, result.rows, f.length, error

    return spark.createDataFrame([outcome(f) for f in listed], MANIFEST)


def _path_only(uri: str) -> str:
    """Path without scheme and authority, such as ``file:`` or ``s3a://bucket``."""
    return re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", uri)


def archive_loaded(spark: SparkSession, manifest: DataFrame, source_dir: str, archive_dir: str, date: str) -> DataFrame:
    """Move the loaded files of a manifest to ``archive_dir/RAW_ARCHIVE/<date>/``; returns the journal (path, target, state).

    Skipped and failed files stay where they are. Files are moved by tasks (:func:`dimflow.storage.move_files`), which can be
    repeated: a file that an earlier attempt or run has moved counts as moved. Source and archive share a file system.
    """
    root = re.escape(_path_only(source_dir).rstrip("/"))
    plain = F.regexp_replace("path", r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "")
    below = F.regexp_replace(plain, f"^{root}/*", "")
    target = F.concat(F.lit(f"{archive_dir.rstrip('/')}/RAW_ARCHIVE/{date}/"), below)
    return storage.move_files(manifest.where(F.col("status") == LOADED).select("path", target.alias("target")))

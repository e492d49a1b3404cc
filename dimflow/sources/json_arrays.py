"""Large JSON documents that hold one array of records, read by many tasks.

A document is read as the pieces that its closing braces end, so that Spark splits it like a file of lines, wherever its
line ends are. Whether a brace ends a record depends on what lies before it: whether a string is open, and how deep the
brackets are. Each piece changes that state in a way that does not depend on the pieces before it but for the one open
string: it turns the string's state over or not, and adds to the depth, one number if it begins outside a string and
another if inside. Such changes compose, so the state at the start of every block (a split of a file) follows from one
row per earlier block, and the pieces of a block are read with it on their own. Pieces of records that lie in one block are
put together there; only those at the edges of blocks, some pieces per block, meet between blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from dimflow import storage

#: Blocks whose states are broadcast, at some 100 bytes each; beyond that they meet their pieces in a join.
BROADCAST_BLOCKS = 200_000

_BLOCK = ["file", "block"]
_STRING = '"[^"]*("|$)'  # to the end of the piece where it stays open
#: What may lie before a record: signs, and elements that are no objects.
_BETWEEN = r'^(?:[^{"]++|"(?:[^"\\]++|\\.)*+")*+'


def _depth(outside: Column) -> Column:
    """Brackets opened less brackets closed in text outside strings."""
    return F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", ""))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of all documents with their place and what they do to the state.

    A piece is valid JSON text but for strings open at its ends, and a backslash is never its last character, so
    escapes end within it.
    """
    read = spark.read.option("lineSep", "}").text(path)
    piece = F.concat("value", F.lit("}"))  # the one behind the last brace of a file gets a brace too many, and ends nothing
    placed = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        piece.alias("piece"),
        F.regexp_replace(piece, r"(?s)\\.", "").alias("plain"),
    )
    from_outside = F.regexp_replace("plain", _STRING, "")
    from_inside = F.regexp_replace(F.regexp_replace("plain", '^[^"]*("|$)', ""), _STRING, "")
    states = placed.select(
        "file",
        "block",
        "at",
        "piece",
        (F.length(F.regexp_replace("plain", '[^"]', "")) % 2).alias("turns"),
        from_outside.alias("outside"),
        from_inside.alias("inside"),
    )
    return states.select(
        "file",
        "block",
        "at",
        "piece",
        "turns",
        *[
            F.struct(_depth(F.col(c)).alias("depth"), F.endswith(F.col(c), F.lit("}")).alias("closes")).alias(c)
            for c in ("outside", "inside")
        ],
        F.regexp_like("piece", F.lit(r"^[\s\x{FEFF}]*\[")).alias("opens_array"),
    )


def _turned(window) -> Column:
    """Whether the pieces before turn the string's state over."""
    return F.coalesce(F.sum("turns").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2


def block_states(pieces: DataFrame) -> DataFrame:
    """(file, block, in_string, depth, record_depth): the state at the start of every block, and the depth behind a record."""
    inside = pieces.withColumn("turned", _turned(Window.partitionBy(*_BLOCK).orderBy("at")))
    same, other = (F.when(F.col("turned") == t, F.col("outside.depth")).otherwise(F.col("inside.depth")) for t in (0, 1))
    blocks = inside.groupBy(*_BLOCK).agg(
        (F.sum("turns") % 2).alias("turns"),
        F.sum(same).alias("from_outside"),
        F.sum(other).alias("from_inside"),
        F.min_by("opens_array", "at").alias("opens_array"),
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("in_string", _turned(order) == 1)
    change = F.when(F.col("in_string"), F.col("from_inside")).otherwise(F.col("from_outside"))
    return blocks.withColumn("change", change).select(
        *_BLOCK,
        "in_string",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.first("opens_array").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("record_depth"),
    )


def json_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record): every object of the arrays in the given JSON documents as its text, in no order.

    A document that is one object is one record. Numbers, strings and the like among the elements are left out, and so are
    empty documents. A record that a document breaks off in is given as far as it goes. What comes after any other syntax
    error in a document is undefined, as quotes decide what a string is.
    """
    pieces = _pieces(spark, path)
    states = block_states(pieces.drop("piece"))
    path_of = storage.scratch_dir(spark, "json-blocks")
    states.write.parquet(path_of)
    states = spark.read.schema(states.schema).parquet(path_of)
    if states.count() <= BROADCAST_BLOCKS:
        states = F.broadcast(states)
    met = pieces.drop("opens_array").join(states, _BLOCK)
    by_place = Window.partitionBy(*_BLOCK).orderBy("at")
    met = met.withColumn("turned", _turned(by_place) == 1)
    effect = F.when(F.col("in_string") == F.col("turned"), F.col("outside")).otherwise(F.col("inside"))
    met = met.select(*_BLOCK, "at", "piece", "depth", "record_depth", effect.alias("effect"))
    depth = F.col("depth") + F.sum("effect.depth").over(by_place)
    ended = met.select(*_BLOCK, "at", "piece", (F.col("effect.closes") & (depth == F.col("record_depth"))).alias("ends"))
    numbered = ended.withColumns(
        {
            "record": F.count_if("ends").over(by_place) - F.col("ends").cast("long"),
            "records": F.count_if("ends").over(Window.partitionBy(*_BLOCK)),
        }
    )
    in_order = F.sort_array(F.collect_list(F.struct("block", "at", "piece")))
    text = F.array_join(F.transform(in_order, lambda x: x["piece"]), "").alias("record")
    within = numbered.filter((F.col("record") > 0) & (F.col("record") < F.col("records")))
    whole = within.withColumnRenamed("record", "number").groupBy(*_BLOCK, "number").agg(text).select("file", "record")

    edges = numbered.filter((F.col("record") == 0) | (F.col("record") == F.col("records")))
    by_file = Window.partitionBy("file").orderBy("block", "at")
    edges = edges.withColumn("number", F.count_if("ends").over(by_file) - F.col("ends").cast("long"))
    crossing = edges.groupBy("file", "number").agg(text, F.bool_or("ends").alias("ended"))
    crossing = crossing.withColumn("record", F.regexp_replace("record", _BETWEEN, ""))
    crossing = crossing.filter("ended or startswith(record, '{')").select("file", "record")
    return whole.withColumn("record", F.regexp_replace("record", _BETWEEN, "")).unionByName(crossing)


def infer_json(spark: SparkSession, records: DataFrame, **options: str) -> StructType:
    """The schema of records given as text, which are stored as JSON Lines to infer it from."""
    lines = storage.scratch_dir(spark, "json-lines")
    records.select(F.regexp_replace("record", r"[\r\n]", " ").alias("value")).write.text(lines)
    return spark.read.options(**options).json(lines).schema


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, **options: str
) -> DataFrame:
    """The records of JSON documents that each hold one array, of any size, with the declared or inferred schema.

    As :func:`dimflow.sources.tables.read_json` with ``multi_line``, but a document is read by as many tasks as a file of
    lines of its size. ``options`` are those of Spark's JSON reader.
    """
    records = json_records(spark, path)
    schema = schema if schema is not None else infer_json(spark, records, **options)
    return records.select(F.from_json("record", schema, options).alias("row")).select("row.*")

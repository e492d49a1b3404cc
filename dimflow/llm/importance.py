"""Target-distribution importance resampling with hashed n-gram features, computed once per distinct line.

A word is never split by a line end, so every run of words lies within a line or crosses the end of one. Features within
a line depend on the line alone: lines are counted over all texts, the buckets of a distinct line's features are computed
once and stored, and its counts and gains are multiplied by its occurrences. Runs that cross line ends are added per text;
they need the two words on each side of an end only. A bucket's gain is the log of its share in the target over its share
in the texts; a text's weight is the sum of its gains, and the texts of highest weight plus Gumbel noise are drawn, which
is sampling without replacement in proportion to the exponent of the weight.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import binary_array, numbered, stored

#: Feature buckets, and the longest run of words that is a feature.
BUCKETS, LONGEST = 10_000, 3
#: A line with more than this part of all lines is joined by broadcast; there are fewer than this number of them.
HOT = 4096

#: Bytes that part words become blanks, A-Z become a-z; what is beyond ASCII is part of a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(line: bytes) -> list[bytes]:
    return line.translate(_FOLD).split()


def line_key(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def line_buckets(line: bytes) -> bytes:
    """The buckets of all runs of words within a line, as packed 16-bit numbers.

    The checksum of a longer run goes on from that of the run without its last word.
    """
    first = words(line)
    added = [b" " + w for w in first]
    sums = list(map(crc32, first))
    found = sums
    for n in range(1, LONGEST):
        sums = list(map(crc32, added[n:], sums))
        found = found + sums
    return (np.array(found, np.int64) % BUCKETS).astype("<u2").tobytes()


def text_parts(text: bytes) -> tuple[int, Counter, bytes]:
    """Words of a text, its lines with their occurrences, and the packed buckets of runs that cross line ends."""
    n, lines, crossing, tail = 0, Counter(), [], []
    for line in text.split(b"\n"):
        found = words(line)
        if not found:
            continue
        n += len(found)
        lines[line] += 1
        # A crossing run ends at one of the first words of this line and starts at one of the last words before it.
        around = tail + found[: LONGEST - 1]
        for end in range(len(tail), len(around)):
            for start in range(max(0, end - LONGEST + 1), min(len(tail), end)):
                crossing.append(crc32(b" ".join(around[start : end + 1])) % BUCKETS)
        tail = (tail + found[1 - LONGEST :])[1 - LONGEST :]
    return n, lines, np.array(crossing, "<u2").tobytes()


_LINE = T.StructType([T.StructField("line", T.BinaryType()), T.StructField("n", T.LongType())])
_PARTS = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("lines", T.ArrayType(_LINE)), T.StructField("crossing", T.BinaryType())]
)


@F.arrow_udf(_PARTS)
def _parts(texts: pa.Array) -> pa.Array:
    n_words, crossing, keys, ns, ends = [], [], [], [], [0]
    for text in texts:
        n, lines, runs = text_parts(text.as_py() or b"")
        n_words.append(n)
        crossing.append(runs)
        keys += map(line_key, lines)
        ns += lines.values()
        ends.append(len(keys))
    line = pa.StructArray.from_arrays([binary_array(keys), pa.array(ns, pa.int64())], ["line", "n"])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), line)
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), lists, binary_array(crossing)], ["n_words", "lines", "crossing"])


def _with_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines as their keys with the buckets of their features; lines without words have none and go."""
    for batch in batches:
        lines, ns = batch["text"].to_pylist(), batch["n"]
        found = [line_buckets(line) for line in lines]
        rows = pa.RecordBatch.from_arrays([binary_array([line_key(x) for x in lines]), ns, binary_array(found)], ["line", "n", "buckets"])
        yield rows.filter(pa.array([len(x) > 0 for x in found], pa.bool_()))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features per bucket of all rows of a task, each row ``n`` times."""
    totals = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        packed, ns = batch["buckets"].to_pylist(), batch["n"].to_numpy()
        times = np.repeat(ns, [len(x) // 2 for x in packed])
        np.add.at(totals, np.frombuffer(b"".join(packed), "<u2"), times)
    used = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])


def _gain_of(gains: np.ndarray):
    """A function for the sum of gains over packed buckets, row by row."""

    @F.arrow_udf(T.LongType())
    def gain(packed: pa.Array) -> pa.Array:
        rows = packed.to_pylist()
        sums = np.concatenate([[0], np.cumsum(gains[np.frombuffer(b"".join(rows), "<u2")])])
        ends = np.cumsum([0, *(len(x) // 2 for x in rows)])
        return pa.array(sums[ends[1:]] - sums[ends[:-1]])

    return gain


def split(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The texts' parts under a number ``__uid`` per row, and the distinct lines with occurrences and buckets."""
    parts = docs.withColumn("__parts", _parts(F.col(text).cast("binary"))).drop(text).select("*", "__parts.*").drop("__parts")
    parts = stored(parts.withColumn("__uid", F.monotonically_increasing_id()), "text-parts")
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    lines = lines.select(F.col("line").cast("binary").alias("text"), "n")
    return parts, stored(lines.mapInArrow(_with_buckets, "line binary, n long, buckets binary"), "lines")


def feature_counts(parts: DataFrame, lines: DataFrame) -> DataFrame:
    """(bucket, n): features of all texts per bucket."""
    sources = (lines.select("n", "buckets"), parts.select(F.lit(1).cast("long").alias("n"), F.col("crossing").alias("buckets")))
    within, across = (x.mapInArrow(_totals, "bucket long, n long") for x in sources)
    return within.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) of every bucket from the counts of texts and target, each smoothed by one per bucket."""
    all_raw, all_target = (x.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias(name)) for x, name in ((raw, "all_s"), (target, "all_t")))
    table = raw.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket")
    for counts, name in ((raw, "s"), (target, "t")):
        table = table.join(F.broadcast(counts.select("bucket", F.col("n").cast("double").alias(name))), "bucket", "left")
    table = table.withColumns({"all_s": all_raw.scalar(), "all_t": all_target.scalar()}).fillna(0.0, ["s", "t"])
    ratio = (F.col("t") + 1) * (F.col("all_s") + BUCKETS) / ((F.col("s") + 1) * (F.col("all_t") + BUCKETS))
    return table.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = 20,
    share: tuple[int, int] = (5, 100),
    seed: str = "42",
) -> DataFrame:
    """Every row of ``docs`` without its text, with ``n_features``, ``weight``, ``score`` and ``rank``.

    ``target`` holds texts in a column of the same name. Rows of at least ``least_words`` words take part in the draw; the
    drawn share of them has ranks from 1, all others a null rank. Null and empty texts have no features and weight 0, and take no
    part unless ``least_words`` is 0. Ties go to the smaller key, null last; rows that also share the key are drawn in any order. Rows
    that repeat a key have the same noise. Columns of the added names are replaced, all others stay. Without target
    texts all buckets have the same small target; without texts the result is empty. A line that many texts share, however
    many, is computed once and meets its texts by broadcast; the others meet in a join in which no line has more than 1 of
    every ``HOT`` lines.
    """
    added = ("n_features", "weight", "score", "rank")
    kept = [c for c in docs.columns if c not in (*added, text)]
    named = [F.col(c).alias(f"__in_{i}") for i, c in enumerate(kept)]
    parts, lines = split(docs.select(*named, F.col(text).alias("__text")), "__text")
    counts = stored(feature_counts(parts, lines), "features")
    target_counts = stored(feature_counts(*split(target.select(F.col(text).alias("__text")), "__text")), "target-features")
    table = np.zeros(BUCKETS, np.int64)
    for row in gains(counts, target_counts).collect():  # one number for each of the fixed number of buckets
        table[row.bucket] = row.gain
    gain = _gain_of(table)
    line_gains = stored(lines.select("line", "n", gain("buckets").alias("gain")), "line-gains").select(F.col("line").alias("__line"), "n", "gain")
    all_lines = line_gains.agg(F.sum("n").alias("n")).scalar()
    is_hot = F.col("n") * HOT > F.col("__all")
    line_gains = line_gains.withColumn("__all", all_lines)
    hot = line_gains.filter(is_hot).select(F.col("__line").alias("__hot"), F.col("gain").alias("__hot_gain"))
    cold = line_gains.filter(~is_hot).select("__line", "gain")
    held = parts.select("__uid", F.explode("lines").alias("held")).select("__uid", "held.line", F.col("held.n").alias("times"))
    met = held.join(F.broadcast(hot), F.col("line") == F.col("__hot"), "left")
    by_hot = met.filter("__hot is not null").select("__uid", (F.col("times") * F.col("__hot_gain")).alias("gain"))
    rest = met.filter("__hot is null").select("__uid", "line", "times")
    by_line = rest.join(cold, F.col("line") == F.col("__line")).select("__uid", (F.col("times") * F.col("gain")).alias("gain"))
    crossing = parts.select("__uid", gain("crossing").alias("gain"))
    weights = by_hot.unionByName(by_line).unionByName(crossing).groupBy("__uid").agg(F.sum("gain").alias("weight"))
    n = F.col("n_words")
    few = F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    found = parts.drop("lines", "crossing").join(weights, "__uid").withColumn("n_features", n + few)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"__in_{kept.index(key)}").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000)
    found = found.withColumns({"score": F.col("weight") + noise, "__takes": n >= least_words}).drop("__uid", "n_words")
    order = [F.desc("__takes"), F.desc("score"), F.col(f"__in_{kept.index(key)}").asc_nulls_last()]
    ranked, _ = numbered(found, order, "rank", "resampled")
    drawn = ranked.agg(F.call_function("div", F.count_if("__takes") * share[0], F.lit(share[1]).cast("long"))).scalar()
    rank = F.when(F.col("__takes") & (F.col("rank") < F.col("__drawn")), F.col("rank") + 1)
    return ranked.withColumn("__drawn", drawn).select(
        *[F.col(f"__in_{i}").alias(c) for i, c in enumerate(kept)], "n_features", "weight", "score", rank.alias("rank")
    )

"""Reproducible shuffles into shards: a Feistel permutation of global row numbers, with DataFrame functions only.

Rows are numbered from 0 in the order of their key. A permutation of the numbers 0 to n - 1 says where each row goes:
place ``p`` is slot ``p div shards`` of shard ``p mod shards``, so shards differ by one row at most and their slots have no
gaps. The permutation is a Feistel network on the pairs of a square of side ``ceil(sqrt(n))``; a value that lands outside
0 to n - 1 is permuted again until it is inside (cycle walking). Less than ``2 sqrt(n) + 1`` values lie outside, so walks are short;
the longest walk of this permutation is found beforehand from those values alone, so that every walk ends.
Nothing is stored: shard and slot follow from a row's number, and the number from shard and slot.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import numbered

#: Rounds of the network.
ROUNDS = 4


class Permutation:
    """A permutation of 0 to ``n`` - 1, the same wherever ``n`` and ``seed`` are the same."""

    def __init__(self, spark: SparkSession, n: int, seed: str):
        self.n, self.seed = n, seed
        self.side = isqrt(n - 1) + 1 if n else 1
        self.walk = self._longest_walk(spark)

    def _noise(self, turn: Column, half: Column) -> Column:
        """52 bits of an MD5 sum over seed, round and half."""
        digest = F.md5(F.concat_ws(":", F.lit(self.seed), turn.cast("string"), half.cast("string")).cast("binary"))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")

    def _rounds(self, value: Column, turns: range, forward: bool) -> Column:
        side = F.lit(self.side).cast("long")

        def turn(pair: Column, i: Column) -> Column:
            left, right = pair["left"], pair["right"]
            if forward:
                return F.struct(right.alias("left"), F.pmod(left + self._noise(i, right), side).alias("right"))
            return F.struct(F.pmod(right - self._noise(i, left), side).alias("left"), left.alias("right"))

        halves = F.struct(F.call_function("div", value, side).alias("left"), F.pmod(value, side).alias("right"))
        order = F.array(*[F.lit(i) for i in turns])
        return F.aggregate(order, halves, turn, lambda pair: pair["left"] * side + pair["right"])

    def _step(self, value: Column) -> Column:
        return self._rounds(value, range(ROUNDS), True)

    def _step_back(self, value: Column) -> Column:
        return self._rounds(value, range(ROUNDS - 1, -1, -1), False)

    def _longest_walk(self, spark: SparkSession) -> int:
        """Steps that the longest walk takes outside 0 to ``n`` - 1.

        Only walks that come from inside count: what lies outside may also turn in cycles of its own.
        """
        outside = spark.range(self.n, self.side**2).filter(self._step_back(F.col("id")) < self.n)
        longest, tried = -1, 16
        while longest < 0:
            start = F.struct(F.col("id").alias("at"), F.lit(0).alias("steps"))
            ahead = F.aggregate(
                F.sequence(F.lit(1), F.lit(tried)),
                start,
                lambda s, _: F.when(s["at"] < self.n, s).otherwise(
                    F.struct(self._step(s["at"]).alias("at"), (s["steps"] + 1).alias("steps"))
                ),
            )
            found = outside.select(ahead.alias("end")).agg(
                F.coalesce(F.max("end.steps"), F.lit(0)).alias("steps"),
                F.coalesce(F.bool_and(F.col("end.at") < self.n), F.lit(True)).alias("inside"),
            ).first()
            longest, tried = (found.steps if found.inside else -1), 4 * tried
        return longest

    def _walked(self, value: Column, step) -> Column:
        first = step(value)
        if not self.walk:
            return first
        more = F.sequence(F.lit(1), F.lit(self.walk))
        return F.aggregate(more, first, lambda v, _: F.when(v < self.n, v).otherwise(step(v)))

    def forward(self, number: Column) -> Column:
        """The place of a row number."""
        return self._walked(number, self._step)

    def backward(self, place: Column) -> Column:
        """The row number at a place."""
        return self._walked(place, self._step_back)

    def row_at(self, shard: Column, slot: Column, shards: int) -> Column:
        """The row number that a slot of a shard holds."""
        return self.backward(slot.cast("long") * shards + shard)


def shard(
    rows: DataFrame, shards: int, *, key: str = "doc_id", seed: str = "shard", prefix: str = ""
) -> tuple[DataFrame, Permutation]:
    """Every row with ``row_number``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0), and the permutation used.

    The names get ``prefix`` in front; columns of these names in the input are replaced, all others stay. Rows are numbered by
    key, null first; rows that repeat a key by a hash of their other columns (but maps), and only rows equal in all of them may
    change places between runs. A key that many rows share is split over tasks. Texts may be null, empty or of any length, as
    they are only hashed. An empty table gives an empty table.
    """
    added = [prefix + name for name in ("row_number", "shard", "slot")]
    kept = rows.drop(*added)
    plain = [c for c, kind in kept.dtypes if "map<" not in kind]
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*plain)]
    found, n = numbered(kept, order, added[0], "shard-rows")
    permutation = Permutation(rows.sparkSession, n, seed)
    place = permutation.forward(F.col(added[0]))
    parts = found.withColumn("__place", place).withColumns(
        {
            added[1]: F.pmod("__place", F.lit(shards)).cast("int"),
            added[2]: F.call_function("div", F.col("__place"), F.lit(shards).cast("long")),
        }
    )
    return parts.drop("__place"), permutation


def write(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000, *, prefix: str = "") -> None:
    """Shards as folders ``shard=…`` of Parquet files in the order of their slots; a shard is written by many tasks."""
    shard_col, slot = prefix + "shard", prefix + "slot"
    chunk = F.call_function("div", F.col(slot), F.lit(rows_per_file).cast("long"))
    ordered = sharded.withColumn("__chunk", chunk).repartition(shard_col, "__chunk").sortWithinPartitions(shard_col, slot)
    ordered.drop("__chunk").write.partitionBy(shard_col).option("maxRecordsPerFile", rows_per_file).parquet(path)

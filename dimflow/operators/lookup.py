"""Lookup joins and uniqueness flags as plain joins.

Catalyst broadcasts a small side; a larger one is joined by sort and merge, and adaptive execution splits the tasks of a
key that holds many rows (``session.py`` turns that on for all joins).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from dimflow.functions.predicates import all_present
from dimflow.operators.dedup import dedup_by_key, has_map


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Mapping[str, str], *, null_safe: bool = False
) -> DataFrame:
    """Left join ``columns`` (dim name -> output name) of ``dim`` onto ``fact``.

    ``on`` maps fact columns to dim columns. The dim is reduced to one row per key, so the fact never fans out. With
    ``null_safe`` NULL keys match each other; otherwise they match nothing, and their rows are dealt by their other
    columns, as a shuffle by the keys would send them all to one task.
    """
    clash = set(columns.values()) & set(fact.columns)
    if clash:
        raise ValueError(f"lookup columns {sorted(clash)} already exist in the fact")
    side_keys = [f"__key{i}" for i in range(len(on))]
    if not null_safe:
        dim = dim.where(all_present(on.values()))
    side = dim.select(
        *(F.col(d).alias(k) for d, k in zip(on.values(), side_keys)),
        *(F.col(c).alias(out) for c, out in columns.items()),
    )
    if null_safe:
        side = dedup_by_key(side, side_keys)
        return fact.join(side, _match(fact, side, list(on), side_keys, null_safe), "left").drop(*side_keys)
    # Every dim row is the first of its key; fact rows without a key ask for numbers that no row has.
    side = dedup_by_key(side, side_keys, rank="__first")
    others = [f.name for f in fact.schema.fields if not has_map(f.dataType)]
    spread = -1 - F.pmod(F.hash(*others), F.lit(1 << 30))
    fact = fact.withColumn("__asked", F.when(all_present(on), F.lit(1)).otherwise(spread))
    keys = _match(fact, side, [*on, "__asked"], [*side_keys, "__first"], null_safe)
    return fact.join(side, keys, "left").drop(*side_keys, "__asked", "__first")


def _match(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(left[a], right[b]) for a, b in zip(left_keys, right_keys)]
    return reduce(and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def flag_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add boolean ``name``: False on every member of a group that shares ``keys``; NULL keys compare equal.

    Groups are counted with map-side combining, and only keys that repeat are joined back.
    """
    repeated = [f"__key{i}" for i in range(len(keys))]
    counts = df.groupBy(*(F.col(k).alias(r) for k, r in zip(keys, repeated))).agg(F.count(F.lit(1)).alias("__count"))
    counts = counts.where("__count > 1")
    joined = df.join(counts, _match(df, counts, keys, repeated, null_safe=True), "left")
    return joined.select(*(df[c] for c in df.columns), F.col("__count").isNull().alias(name))

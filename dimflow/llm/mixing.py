"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

A source's target is a number of words. ``target / source_size`` says how often a document of the source is wanted on
average: its whole part is copies that every document gets for certain, its fraction is the inclusion probability ``p``
of one copy more. That copy goes to the documents of smallest rank ``(u / (1 - u)) / (p / (1 - p))``, with ``u`` a hash
of the document's key, until the source's remaining words are used up. The rank is found without sorting a source in
one task: words are summed per narrow band of ``u``, a running sum over bands finds the one band in which the words run
out, and only that band is ordered. What is left of a source is one number, the last rank taken, so documents are not
shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.llm.common import WORD, stored

#: Documents aimed for in a band of ranks. Changes the work only, not the result.
BAND_DOCS = 4096


def words(text: Column | str) -> Column:
    """Number of words of a text; 0 for null and empty ones."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: str, seed: str) -> Column:
    """A number in (0, 1) that depends on the key and the seed only: 52 bits of an MD5 sum."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Targets for rows (source, source_size), one per source: weights go round in code point order, null last.

    Targets share ``share`` times all words by weight; none is above ``cap`` times its source's words, and what is cut
    is shared again among the others. In order of ``cap / weight`` this has a closed form: the highest level at
    which a source stays below its cap. The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", wheel[(F.row_number().over(order) - 1) % len(weights)])
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(cap))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    ranked = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    )
    below = F.when(F.col("most") >= F.col("level") * F.col("weight"), F.col("level"))
    return ranked.withColumn("fill", F.max(below).over(everything)).select(
        "source",
        "source_size",
        F.when(F.col("fill").isNull(), F.col("most")).otherwise(F.least("most", F.col("fill") * F.col("weight"))).alias("target"),
    )


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
    prefix: str = "",
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 up to ``cap``).

    The names get ``prefix`` in front; columns of these names in the input are replaced. Null texts and texts without words have size 0; they get the
    copies their rank gives them, which add no words. A null source is a source of its own, after all others. Rows that
    repeat a key share its rank; where the words run out among them, only as many as needed are taken. An empty table
    gives an empty table. A source without words has target 0. Reruns agree, as ranks are hashes.
    """
    added = [prefix + name for name in ("size", "source_size", "target", "copies")]
    kept = [c for c in docs.columns if c not in added]
    base = docs.select(
        *[F.col(c).alias(f"__in_{i}") for i, c in enumerate(kept)],
        F.col(source).alias("__source"),
        words(text).alias("__size"),
        uniform(key, seed).alias("__u"),
    )
    slim = stored(base.select(F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__u").alias("u")), "mix")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = targets(sizes.select("source", "source_size"), weights, share, cap)
    goal = goal.alias("g").join(sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = stored(
        goal.withColumns({"sure": F.floor(ratio), "p": ratio - F.floor(ratio)}).withColumns(
            {"wanted": F.col("target") - F.col("sure") * F.col("source_size"), "bands": F.ceil(F.col("n") / BAND_DOCS)}
        ),
        "mix-goal",
    )
    cut = _cutoffs(slim, goal)
    plan = goal.alias("g").join(cut.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left").select("g.*", "last", "taken_at_last", "all_at_last")
    plan = stored(plan, "mix-plan").select(
        F.col("source").alias("__plan"), "source_size", "target", "sure", "p", "last", "taken_at_last", "all_at_last"
    )
    matched = base.join(plan, F.col("__source").eqNullSafe(F.col("__plan")))
    rank = _rank(F.col("__u"), F.col("p"))
    split = F.coalesce((rank == F.col("last")) & (F.col("taken_at_last") < F.col("all_at_last")), F.lit(False))
    whole = matched.filter(~split).withColumn("__more", F.coalesce(rank <= F.col("last"), F.lit(False)).cast("long"))
    # Rows that repeat one key at the very end of a source's ranks, almost always none.
    shared = Window.partitionBy("__source").orderBy("__size")
    parted = matched.filter(split).withColumn("__more", (F.row_number().over(shared) <= F.col("taken_at_last")).cast("long"))
    return (
        whole.unionByName(parted)
        .withColumn("__copies", F.col("sure") + F.col("__more"))
        .select(
            *[F.col(f"__in_{i}").alias(c) for i, c in enumerate(kept)],
            *[F.col(c).alias(n) for c, n in zip(("__size", "source_size", "target", "__copies"), added, strict=True)],
        )
    )


def _rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where no document is wanted beyond the sure copies."""
    return F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def _cutoffs(slim: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source the last rank taken, how many rows have it and how many of them are taken.

    A document is taken if at least half of it still fits, so a source misses its target by half a document at most.
    """
    wanted = goal.filter("p > 0").select(F.col("source").alias("s"), "wanted", "bands", "p")
    banded = slim.join(wanted, F.col("source").eqNullSafe(F.col("s"))).withColumn("band", F.floor(F.col("u") * F.col("bands")))
    sums = banded.groupBy("source", "band").agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
    running = Window.partitionBy("source").orderBy("band")
    edge = (
        sums.withColumn("after", F.sum("words").over(running))
        .filter(F.col("after") >= F.col("wanted"))
        .withColumn("k", F.row_number().over(running))
        .filter("k = 1")
        .select(F.col("source").alias("edge"), F.col("band").alias("edge_band"), (F.col("after") - F.col("words")).alias("before"))
    )
    near = banded.join(edge, F.col("source").eqNullSafe(F.col("edge")) & (F.col("band") == F.col("edge_band")))
    in_order = Window.partitionBy("source").orderBy("u", "size")
    ranked = near.withColumn("upto", F.col("before") + F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumns({"fits": F.col("upto") - F.col("size") / 2 <= F.col("wanted"), "rank": _rank(F.col("u"), F.col("p"))})
    ends = ranked.groupBy("source").agg(
        F.max(F.when(F.col("fits"), F.col("rank"))).alias("in_band"),
        F.first(_rank(F.col("edge_band") / F.col("bands"), F.col("p"))).alias("below_band"),
    )
    ends = ends.select(F.col("source").alias("e"), F.coalesce("in_band", "below_band").alias("last"))
    return (
        ranked.join(ends, F.col("source").eqNullSafe(F.col("e")))
        .groupBy("source", "last")
        .agg(
            F.count(F.when(F.col("fits") & (F.col("rank") == F.col("last")), 1)).alias("taken_at_last"),
            F.count(F.when(F.col("rank") == F.col("last"), 1)).alias("all_at_last"),
        )
    )


def repeat(mixed: DataFrame, copies: str = "__copies") -> DataFrame:
    """Rows of :func:`mix` as often as the mix takes them."""
    wanted = mixed.filter(F.col(copies) > 0)
    return wanted.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).drop("__copy")

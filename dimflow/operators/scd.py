"""Slowly changing dimensions, type 1 and type 2, as one-pass merges.

Both merges join source and dimension once, decide each row's class, and derive all
output rows from it. Keys are unique on both sides of the join, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DateType

from dimflow.entities import EntitySpec
from dimflow.functions.predicates import all_present
from dimflow.operators.dedup import dedup_by_key
from dimflow.schemas import conform

ABSENT_POLICIES = ("keep", "expire", "drop")


def _sides(dim: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dimension and source rows side by side: ``d_*`` and ``s_*``, one row per key.

    ``in_dim`` and ``in_src`` are NULL where a side has no row.
    """
    d = dim.select(*keys, *(F.col(c).alias(f"d_{c}") for c in dim.columns if c not in keys), F.lit(True).alias("in_dim"))
    s = source.select(
        *keys, *(F.col(c).alias(f"s_{c}") for c in source.columns if c not in keys), F.lit(True).alias("in_src")
    )
    return d.join(s, list(keys), "full_outer")


def _same(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"d_{c}").eqNullSafe(F.col(f"s_{c}")) for c in columns))


def _one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], unique: bool) -> DataFrame:
    keyed = source.where(all_present(keys))
    return keyed if unique else dedup_by_key(keyed, keys, order_by)


def scd2_first_load(source: DataFrame, spec: EntitySpec, as_of: str) -> DataFrame:
    """Every source row as the open version of its key."""
    stamp = F.lit(as_of).cast(spec.stamp_type)
    stamps = {spec.start: stamp, spec.active: F.lit(True), spec.end: F.lit(None).cast(spec.stamp_type)}
    if spec.updated:
        stamps[spec.updated] = stamp
    return source.select(*spec.columns).withColumns(stamps).select(*spec.dim_schema.fieldNames())


def scd2_merge(
    dim: DataFrame | None,
    source: DataFrame,
    spec: EntitySpec,
    as_of: str,
    *,
    absent: str = "keep",
    order_by: Sequence[Column | str] = (),
    unique_source: bool = False,
    include_history: bool = True,
) -> DataFrame:
    """The dimension after merging ``source`` at ``as_of``.

    A changed row closes its version and opens a new one; an unchanged row is kept;
    a new key is opened. Keys missing from the source follow ``absent``: kept, closed
    ("expire") or removed ("drop"). Closed versions pass through untouched, or are
    left out with ``include_history=False`` when the caller stores them apart.
    Source rows without a key are ignored. ``dim=None`` is the first load.
    """
    if absent not in ABSENT_POLICIES:
        raise ValueError(f"absent must be one of {ABSENT_POLICIES}, not {absent!r}")
    keys = list(spec.key)
    source = _one_per_key(conform(source, spec.schema), keys, order_by, unique_source)
    if dim is None:
        return scd2_first_load(source, spec, as_of)
    dim = conform(dim, spec.dim_schema)
    is_open = F.coalesce(F.col(spec.active), F.lit(False)) & all_present(keys)

    rows = _sides(dim.where(is_open), source, keys)
    if absent == "drop":
        rows = rows.where("in_src")
    rows = rows.withColumn(
        "row_class",
        F.when(F.col("in_dim").isNull(), "new")
        .when(F.col("in_src").isNull(), "absent")
        .when(_same(spec.tracked), "unchanged")
        .otherwise("changed"),
    )
    # A changed row becomes two: the version that closes and the version that opens.
    rows = rows.withColumn(
        "part",
        F.explode(
            F.when(F.col("row_class") == "changed", F.array(F.lit("close"), F.lit("open")))
            .when(F.col("row_class") == "new", F.array(F.lit("open")))
            .when((F.col("row_class") == "absent") & F.lit(absent == "expire"), F.array(F.lit("close")))
            .otherwise(F.array(F.lit("keep")))
        ),
    )
    opens, closes = F.col("part") == "open", F.col("part") == "close"
    stamp, never = F.lit(as_of).cast(spec.stamp_type), F.lit(None).cast(spec.stamp_type)

    out = {c: F.col(c) if c in keys else F.when(opens, F.col(f"s_{c}")).otherwise(F.col(f"d_{c}")) for c in spec.columns}
    out[spec.start] = F.when(opens, stamp).otherwise(F.col(f"d_{spec.start}"))
    if spec.updated:
        untouched = (F.col("row_class") == "absent") & ~closes
        out[spec.updated] = (
            F.when(opens, never).when(untouched, F.col(f"d_{spec.updated}")).otherwise(stamp)
        )
    out[spec.active] = ~closes
    out[spec.end] = F.when(closes, stamp).otherwise(never)
    merged = rows.select(*(out[c].alias(c) for c in spec.dim_schema.fieldNames()))
    return merged.unionByName(dim.where(~is_open)) if include_history else merged


def scd2_history(
    dim: DataFrame | None,
    source: DataFrame,
    spec: EntitySpec,
    effective: str,
    as_of: str,
    *,
    order_by: Sequence[Column | str] = (),
) -> DataFrame:
    """The dimension after changes that take effect at ``source``'s column ``effective``, any number per key, early or late.

    A key's versions and changes are put in order as points in time, and each lasts until the next: a change within a closed
    version splits it, one before all others precedes them, and the end of a version that nothing follows stays a
    gap until the next point. A change at the start of a version takes its place; of several at the same time the first by
    ``order_by`` counts. A point that has the tracked values of the point before it changes nothing, so the earlier version
    lasts longer; it is not remembered, so a change that arrives later and falls before it lasts beyond it. New versions have no update stamp; versions that end at another time than before get ``as_of``. Keys without
    changes pass through unshuffled but for the search for them. Rows without key or effective time are ignored. Versions of
    a key in ``dim`` must not overlap. The versions of one key are ordered in one task.
    """
    keys = list(spec.key)
    changes = source.select(
        *(F.col(f.name).cast(f.dataType) for f in spec.schema.fields), F.col(effective).cast(spec.stamp_type).alias("__at")
    ).where(all_present(keys) & F.col("__at").isNotNull())
    changes = dedup_by_key(changes, [*keys, "__at"], order_by)
    stamp, never = F.lit(as_of).cast(spec.stamp_type), F.lit(None).cast(spec.stamp_type)
    point = {"__end": never, "__updated": never, "__kind": F.lit(0)}
    points = changes.withColumns(point)
    untouched = None
    if dim is not None:
        dim = conform(dim, spec.dim_schema)
        touched = changes.select(*(F.col(k).alias(f"__k_{k}") for k in keys)).distinct().withColumn("__touched", F.lit(True))
        same_key = reduce(and_, (F.col(k) == F.col(f"__k_{k}") for k in keys))
        marked = dim.join(touched, same_key, "left")
        untouched = marked.where("__touched IS NULL").select(*dim.columns)
        old = marked.where("__touched").select(
            *spec.columns,
            F.col(spec.start).alias("__at"),
            F.col(spec.end).alias("__end"),
            (F.col(spec.updated) if spec.updated else never).alias("__updated"),
            F.lit(1).alias("__kind"),
        )
        values = [c for c in spec.columns if c not in keys]
        ends = old.where("__end IS NOT NULL").withColumns({"__at": F.col("__end"), "__kind": F.lit(2)})
        ends = ends.withColumns({c: F.lit(None).cast(spec.schema[c].dataType) for c in values})
        points = points.unionByName(old).unionByName(ends)
    # Of points at one time a change comes before a version, and a version before an end.
    points = points.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys, "__at").orderBy("__kind"))).where("__rank = 1")
    by_time = Window.partitionBy(*keys).orderBy("__at")
    tracked = F.struct(*(F.col(c) for c in spec.tracked), (F.col("__kind") == 2).alias("__gap"))
    before = F.lag(tracked).over(by_time)
    first_gap = before.isNull() & (F.col("__kind") == 2)
    points = points.withColumn("__same", tracked.eqNullSafe(before) | first_gap).where("NOT __same")
    points = points.withColumn("__until", F.lead("__at").over(by_time)).where("__kind <> 2")
    kept = (F.col("__kind") == 1) & F.col("__until").eqNullSafe(F.col("__end"))
    out = {c: F.col(c) for c in spec.columns}
    out[spec.start], out[spec.end], out[spec.active] = F.col("__at"), F.col("__until"), F.col("__until").isNull()
    if spec.updated:
        out[spec.updated] = F.when(F.col("__kind") == 0, never).when(kept, F.col("__updated")).otherwise(stamp)
    merged = points.select(*(out[c].alias(c) for c in spec.dim_schema.fieldNames()))
    return merged if untouched is None else merged.unionByName(untouched)


def scd1_merge(
    dim: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: str,
    *,
    inserted: str = "ins_dt",
    updated: str = "upd_dt",
    stamp_type: DataType = DateType(),
    order_by: Sequence[Column | str] = (),
    unique_source: bool = False,
) -> DataFrame:
    """``dim`` with changed rows overwritten and new rows inserted.

    Only ``tracked`` columns are compared and overwritten. Other columns are taken
    from the source on insert and left alone afterwards. Rows the source does not
    mention stay as they are.
    """
    keys = list(keys)
    attributes = [c for c in dim.columns if c not in (*keys, inserted, updated)]
    source = _one_per_key(source.select(*keys, *attributes), keys, order_by, unique_source)
    has_key = all_present(keys)
    rows = _sides(dim.where(has_key), source, keys)

    is_new = F.col("in_dim").isNull()
    changed = F.col("in_dim") & F.col("in_src") & ~_same(tracked)
    stamp, never = F.lit(as_of).cast(stamp_type), F.lit(None).cast(stamp_type)
    out = {k: F.col(k) for k in keys}
    for c in attributes:
        out[c] = F.when(is_new | changed if c in tracked else is_new, F.col(f"s_{c}")).otherwise(F.col(f"d_{c}"))
    out[inserted] = F.when(is_new, stamp).otherwise(F.col(f"d_{inserted}"))
    out[updated] = F.when(is_new, never).when(changed, stamp).otherwise(F.col(f"d_{updated}"))
    return rows.select(*(out[c].alias(c) for c in dim.columns)).unionByName(dim.where(~has_key))

"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = (), rank: str | None = None
) -> DataFrame:
    """Keep the first row of each key group; NULL keys form one group. ``rank`` names a column that keeps its number, 1.

    The remaining columns (maps have no order) break ties, so the surviving row is the same on every run.
    Spark keeps only the best row per key in each map task before the shuffle
    (WindowGroupLimit), so a key with very many rows does not burden one task.
    """
    ties = [f.name for f in df.schema.fields if f.name not in keys and not has_map(f.dataType)]
    order = [*order_by, *ties] or [F.lit(0)]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.withColumn(rank or "__rank", number).where(F.col(rank or "__rank") == 1)
    return first if rank else first.drop("__rank")


def has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType)


def comparable(value: Column, kind: DataType) -> Column:
    """``value`` with every map in it as its entries in order of their keys, so that equal maps are equal values."""
    if not has_map(kind):
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = (comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields)
        return F.when(value.isNotNull(), F.struct(*fields))
    entry = lambda e: F.struct(e["key"].alias("key"), comparable(e["value"], kind.valueType).alias("value"))
    return F.array_sort(F.transform(F.map_entries(value), entry))


def remove_duplicates(
    df: DataFrame, columns: Sequence[str] | None = None, order_by: Sequence[Column | str] = ()
) -> DataFrame:
    """Distinct whole rows, or one row per combination of ``columns``. Maps are equal if their entries are, in any order."""
    if columns:
        return dedup_by_key(df, columns, order_by)
    maps = [f for f in df.schema.fields if has_map(f.dataType)]
    if not maps:
        return df.distinct()
    keys = {f"__key_{i}": comparable(F.col(f.name), f.dataType) for i, f in enumerate(maps)}
    plain = [c for c in df.columns if c not in {f.name for f in maps}]
    return df.withColumns(keys).dropDuplicates([*plain, *keys]).drop(*keys)

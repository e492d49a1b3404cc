"""Cleansing of customer records and preparation of dimension sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dimflow.entities import EntitySpec
from dimflow.functions.predicates import all_present
from dimflow.operators.dedup import dedup_by_key
from dimflow.schemas import require_columns

# The fields a cleansed customer must have.
CUSTOMER_REQUIRED = ("customer_id", "first_name", "last_name", "address")


def cleanse_customers(
    df: DataFrame,
    key: str = "customer_id",
    required: Sequence[str] = CUSTOMER_REQUIRED,
    order_by: Sequence[Column | str] = (),
    drop_nulls_first: bool = False,
) -> DataFrame:
    """One complete row per customer, with the two name parts joined into ``full_name``.

    Duplicates go before incomplete rows, so an incomplete duplicate may win and then
    be dropped; ``drop_nulls_first`` swaps the two steps.
    """
    require_columns(df, [key, "first_name", "last_name", *required])
    if drop_nulls_first:
        kept = dedup_by_key(df.na.drop(subset=list(required)), [key], order_by)
    else:
        kept = dedup_by_key(df, [key], order_by).na.drop(subset=list(required))
    return kept.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name")).drop("first_name", "last_name")


def prepare(df: DataFrame, spec: EntitySpec, as_of: str) -> DataFrame:
    """Rows with every mandatory field of ``spec``, stamped with the load time."""
    stamp = F.lit(as_of).cast(spec.stamp_type)
    require_columns(df, spec.required)
    stamps = {spec.start: stamp}
    if spec.updated:
        stamps[spec.updated] = stamp
    return df.where(all_present(spec.required)).withColumns(stamps)

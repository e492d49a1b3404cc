"""Column profiles and single-column format checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from dimflow.functions.rules import EMAIL_PATTERN, matches

# Fixed value: international phone number format.
E164_PATTERN = r"^\+?[1-9]\d{1,14}$"


def null_nan_profile(df: DataFrame) -> DataFrame:
    """(column, null_count, nan_count), counted for all columns in one pass.

    Only float and double columns can hold NaN; other types report 0.
    """
    pairs = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        nans = F.count_if(F.isnan(col)) if isinstance(f.dataType, (FloatType, DoubleType)) else F.lit(0).cast("long")
        pairs.append(
            F.struct(F.lit(f.name).alias("column"), F.count_if(col.isNull()).alias("null_count"), nans.alias("nan_count"))
        )
    return df.agg(F.array(*pairs).alias("counts")).select(F.inline("counts"))


def flag_email(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("email_valid", matches(F.col(column), EMAIL_PATTERN))


def flag_phone(df: DataFrame, column: str, method: str = "regex") -> DataFrame:
    """``phone_valid`` by E.164 pattern, or by length (7 to 15) with ``method="length"``."""
    phone = F.col(column).cast("string")
    if method == "regex":
        valid = matches(phone, E164_PATTERN)
    elif method == "length":
        valid = F.coalesce(F.length(F.translate(phone, "+- ", "")).between(7, 15), F.lit(False))
    else:
        raise ValueError(f"unknown phone check {method!r}")
    return df.withColumn("phone_valid", valid)

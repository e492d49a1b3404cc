"""Declared schemas, and the functions that hold a DataFrame to one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)


STRING, INT, LONG, DOUBLE, BOOLEAN = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType()
DATE, TIMESTAMP, TIMESTAMP_NTZ = DateType(), TimestampType(), TimestampNTZType()


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def strings(*names: str) -> StructType:
    return struct(**dict.fromkeys(names, STRING))


# Insurance sources and dimensions.
CUSTOMER = struct(
    customer_id=STRING, first_name=STRING, last_name=STRING, dob=DATE, gender=STRING,
    address=STRING, city=STRING, state=STRING, zip=STRING,
)
POLICY = struct(
    policy_id=STRING, policy_type=STRING, coverage_type=STRING, start_date=DATE, end_date=DATE,
    annual_premium=DecimalType(12, 2),
)
PROVIDER = strings("provider_id", "provider_name", "type", "address", "city", "state")
HOSPITAL = strings("hospital_id", "hospital_name", "location", "accreditation")
REGION = strings("region_id", "state", "zone", "city")
PRODUCT = strings("product_id", "product_name", "coverage", "description")
VEHICLE = struct(
    vehicle_id=STRING, customer_id=STRING, make=STRING, model=STRING, year=INT, registration_no=STRING
)
CLAIM = struct(
    claim_id=STRING, customer_id=STRING, policy_id=STRING, provider_id=STRING, claim_date=DATE,
    claim_type=STRING, claim_amount=DecimalType(14, 2), approved_amount=DecimalType(14, 2),
    claim_status=STRING, region_id=STRING, submission_channel=STRING, inserted_at=TIMESTAMP_NTZ,
)

# Event logs and the tables built from them.
EVENT_LOG = struct(
    log_id=STRING, user_id=STRING, timestamp=STRING, event_type=STRING, product_id=STRING, category=STRING,
    quantity=DecimalType(10, 2), price=DOUBLE, total_amount=DOUBLE,
    cart_items=ArrayType(struct(product_id=STRING, quantity=DecimalType(10, 2), price=DOUBLE)),
)
CART_LINE = struct(product_id=STRING, quantity=DecimalType(10, 2), price=DecimalType(12, 2))
PRODUCT_DETAILS = strings("product_id", "name", "category", "description")
USER_DETAILS = strings("user_id", "user_name")
EVENT_TYPE = struct(event_type_key=INT, event_type_name=STRING, description=STRING)
FACT_USER_EVENTS = struct(
    log_id=STRING, user_id=STRING, event_date=DATE, event_timestamp=TIMESTAMP_NTZ, event_type=STRING,
    product_id=STRING, product_id_hash=STRING, category=STRING, quantity=DecimalType(10, 2),
    unit_price=DecimalType(12, 2), total_amount=DecimalType(14, 2), cart_total=DecimalType(14, 2),
)

# Webshop customer, type 1 and type 2.
RAW_CUSTOMER = struct(
    id=INT, firstname=STRING, lastname=STRING, gender=STRING, email=STRING, dateofbirth=DATE, currentaddressid=INT
)
DIM_CUSTOMER_TYPE1 = StructType(RAW_CUSTOMER.fields + struct(ins_dt=DATE, upd_dt=DATE).fields)
DIM_CUSTOMER_TYPE2 = StructType(
    RAW_CUSTOMER.fields + struct(start_date=DATE, is_current=BOOLEAN, end_date=DATE).fields
)

# Customer validation input is read as strings, so that no value is lost to type inference.
CUSTOMER_VALIDATION = strings(
    "customer_id", "full_name", "email", "age", "date_of_birth", "phone_number", "country"
)

AUDIT = struct(jobname=STRING, runid=STRING, lastrundate=TIMESTAMP)
MANIFEST = struct(
    path=STRING, format=STRING, target=STRING, status=STRING, row_count=LONG, length=LONG, error=STRING
)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise when a column is missing; checked on the schema, before any job runs."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto ``schema``: declared order and types, typed NULL for absent columns.

    Values that do not parse become NULL, so one bad row cannot end the job.
    """
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        )
    )

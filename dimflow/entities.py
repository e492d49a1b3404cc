"""Per-entity configuration of the type 2 dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructField, StructType, TimestampNTZType, BooleanType, DataType, DateType

from dimflow import schemas


@dataclass(frozen=True)
class EntitySpec:
    """Key, mandatory and tracked columns of a dimension, and its version columns."""

    name: str
    schema: StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    tracked: tuple[str, ...]
    active: str = "is_active"
    start: str = "insert_date"
    updated: str | None = "update_date"
    end: str = "end_date"
    stamp_type: DataType = TimestampNTZType()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def dim_schema(self) -> StructType:
        stamps = [StructField(self.start, self.stamp_type)]
        if self.updated:
            stamps.append(StructField(self.updated, self.stamp_type))
        stamps += [StructField(self.active, BooleanType()), StructField(self.end, self.stamp_type)]
        return StructType(self.schema.fields + stamps)


# Which columns each entity requires and tracks.
CUSTOMER = EntitySpec(
    "customer", schemas.CUSTOMER, ("customer_id",),
    required=("address", "first_name", "last_name"),
    tracked=("first_name", "last_name", "dob", "gender", "address", "city", "state", "zip"),
)
HOSPITAL = EntitySpec(
    "hospital", schemas.HOSPITAL, ("hospital_id",),
    required=("hospital_id", "hospital_name", "location"),
    tracked=("hospital_name", "location", "accreditation"),
)
POLICY = EntitySpec(
    "policy", schemas.POLICY, ("policy_id",),
    required=("policy_id", "policy_type", "coverage_type", "start_date", "end_date", "annual_premium"),
    tracked=("policy_type", "coverage_type", "start_date", "end_date", "annual_premium"),
    end="end_date_version",  # end_date is a business column of a policy
)
PRODUCT = EntitySpec(
    "product", schemas.PRODUCT, ("product_id",),
    required=("product_id", "product_name", "coverage", "description"),
    tracked=("product_name", "coverage", "description"),
)
PROVIDER = EntitySpec(
    "provider", schemas.PROVIDER, ("provider_id",),
    required=("provider_id", "provider_name", "type", "address", "city", "state"),
    tracked=("provider_name", "type", "address", "city", "state"),
)
REGION = EntitySpec(
    "region", schemas.REGION, ("region_id",),
    required=("region_id", "state", "zone", "city"),
    tracked=("state", "zone", "city"),
)
VEHICLE = EntitySpec(
    "vehicle", schemas.VEHICLE, ("vehicle_id",),
    required=("vehicle_id", "customer_id", "make", "model", "year", "registration_no"),
    tracked=("customer_id", "make", "model", "year", "registration_no"),
)
WEBSHOP_CUSTOMER = EntitySpec(
    "webshop_customer", schemas.RAW_CUSTOMER, ("id",),
    required=(),
    tracked=("firstname", "lastname", "gender", "email", "currentaddressid"),
    active="is_current", start="start_date", updated=None, stamp_type=DateType(),
)

ENTITIES = {
    e.name: e
    for e in (CUSTOMER, HOSPITAL, POLICY, PRODUCT, PROVIDER, REGION, VEHICLE, WEBSHOP_CUSTOMER)
}

# Type 1 merge of the webshop customer: the columns compared and overwritten.
WEBSHOP_TYPE1_TRACKED = ("firstname", "lastname", "email", "currentaddressid")

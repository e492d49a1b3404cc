"""Warehouse inputs derived from the given tables.

Each select list is plain SQL that both engines evaluate alike, so a query and its
check start from the same rows. Every list covers its whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dimflow.plans.base import load

AS_OF = "2024-06-30 00:00:00"
LOADED_AT = "2024-01-01 00:00:00"
CLOSED_AT = "2023-06-30 00:00:00"


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items()))


# Customers in the shape of the validation input: some values break some rule.
_BIRTH = "CAST(floor(c_custkey / 4) AS bigint)"
PEOPLE = {
    "customer_id": "CASE WHEN c_custkey % 97 = 0 THEN concat('x', CAST(c_custkey AS string)) "
    "WHEN c_custkey % 89 = 0 THEN concat('-', CAST(c_custkey AS string)) ELSE CAST(c_custkey AS string) END",
    "full_name": "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN c_name "
    f"ELSE concat(c_mktsegment, ' ', chr(CAST(65 + {_BIRTH} % 26 AS int))) END",
    "email": "CASE WHEN c_custkey % 13 = 0 THEN 'nobody.example.com' WHEN c_custkey % 13 = 1 THEN NULL "
    "ELSE concat(lower(replace(c_name, '#', '.')), '@example.com') END",
    "age": f"CASE WHEN c_custkey % 17 = 0 THEN 'unknown' WHEN c_custkey % 17 = 1 THEN '150' "
    f"ELSE CAST(2024 - (1930 + {_BIRTH} % 90) + c_custkey % 4 - 2 AS string) END",
    "date_of_birth": f"concat(CAST(1930 + {_BIRTH} % 100 AS string), '-', CAST(1 + {_BIRTH} % 13 AS string), '-', "
    f"lpad(CAST(1 + {_BIRTH} % 31 AS string), 2, '0'))",
    "phone_number": "CASE WHEN c_custkey % 19 = 0 THEN '12345' WHEN c_custkey % 19 = 1 THEN concat('+', CAST(c_custkey AS string)) "
    "ELSE lpad(CAST(c_custkey * 7919 AS string), 10, '9') END",
    "country": "CASE c_custkey % 8 WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'India' WHEN 3 THEN 'Canada' "
    "WHEN 4 THEN 'Australia' WHEN 5 THEN 'Ireland' WHEN 6 THEN 'Mars' ELSE NULL END",
}


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(load(spark, sf_dir, "customer"), PEOPLE)


PEOPLE_SQL = f"SELECT {select_list(PEOPLE)} FROM customer"


@dataclass(frozen=True)
class Binding:
    """A given table in the shape of an entity, and the tracked column its new snapshot alters."""

    entity: str
    table: str
    number: str
    columns: dict[str, str]
    altered: str


def _key(number: str) -> str:
    return f"CAST({number} AS string)"


BINDINGS = {
    b.entity: b
    for b in (
        Binding(
            "customer", "customer", "c_custkey",
            {
                "customer_id": _key("c_custkey"),
                "first_name": "c_mktsegment",
                "last_name": "c_name",
                "dob": "CAST('1950-01-01' AS date) + CAST(c_custkey % 20000 AS int)",
                "gender": "CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END",
                "address": "concat(CAST(c_nationkey AS string), ' Main St, Apt ', CAST(c_custkey AS string))",
                "city": "concat('City ', CAST(c_nationkey AS string))",
                "state": "concat('State ', CAST(c_nationkey % 5 AS string))",
                "zip": "lpad(CAST(c_custkey % 100000 AS string), 5, '0')",
            },
            "city",
        ),
        Binding(
            "hospital", "supplier", "s_suppkey",
            {
                "hospital_id": _key("s_suppkey"),
                "hospital_name": "s_name",
                "location": "concat('Nation ', CAST(s_nationkey AS string))",
                "accreditation": "CASE WHEN s_nationkey % 3 = 0 THEN 'NABH' ELSE 'ISO Certified' END",
            },
            "accreditation",
        ),
        Binding(
            "policy", "orders", "o_orderkey",
            {
                "policy_id": _key("o_orderkey"),
                "policy_type": "o_orderpriority",
                "coverage_type": "o_orderstatus",
                "start_date": "CAST(o_orderdate AS date)",
                "end_date": "CAST(o_orderdate AS date) + 365",
                "annual_premium": "CAST(o_totalprice AS decimal(12,2))",
            },
            "policy_type",
        ),
        Binding(
            "product", "part", "p_partkey",
            {
                "product_id": _key("p_partkey"),
                "product_name": "p_name",
                "coverage": "p_brand",
                "description": "p_type",
            },
            "description",
        ),
        Binding(
            "provider", "supplier", "s_suppkey",
            {
                "provider_id": _key("s_suppkey"),
                "provider_name": "s_name",
                "type": "CASE WHEN s_suppkey % 2 = 0 THEN 'Agent' ELSE 'Hospital' END",
                "address": "concat(CAST(s_suppkey AS string), ' High St, Floor 2')",
                "city": "concat('City ', CAST(s_nationkey AS string))",
                "state": "concat('State ', CAST(s_nationkey % 5 AS string))",
            },
            "city",
        ),
        Binding(
            "region", "nation", "n_nationkey",
            {
                "region_id": _key("n_nationkey"),
                "state": "n_name",
                "zone": "concat('Zone ', CAST(n_regionkey AS string))",
                "city": "concat('Capital of ', n_name)",
            },
            "zone",
        ),
        Binding(
            "vehicle", "orders", "o_orderkey",
            {
                "vehicle_id": _key("o_orderkey"),
                "customer_id": _key("o_custkey"),
                "make": "o_orderpriority",
                "model": "o_orderstatus",
                "year": "CAST(year(o_orderdate) AS int)",
                "registration_no": "concat('REG-', CAST(o_orderkey AS string))",
            },
            "make",
        ),
        Binding(
            "webshop_customer", "customer", "c_custkey",
            {
                "id": "CAST(c_custkey AS int)",
                "firstname": "c_mktsegment",
                "lastname": "c_name",
                "gender": "CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END",
                "email": "concat(lower(replace(c_name, '#', '.')), '@example.com')",
                "dateofbirth": "CAST('1950-01-01' AS date) + CAST(c_custkey % 20000 AS int)",
                "currentaddressid": "c_nationkey",
            },
            "email",
        ),
    )
}


def snapshot(b: Binding) -> dict[str, str]:
    """The entity's next snapshot: some keys vanish and others appear, some rows change, some become NULL."""
    key, *_ = b.columns
    columns = dict(b.columns)
    moved = f"-{b.number} - 1"
    columns[key] = columns[key].replace(b.number, f"CASE WHEN {b.number} % 7 = 0 THEN {moved} ELSE {b.number} END", 1)
    altered = columns[b.altered]
    columns[b.altered] = (
        f"CASE WHEN {b.number} % 4 = 0 THEN concat({altered}, ' v2') WHEN {b.number} % 6 = 1 THEN NULL ELSE {altered} END"
    )
    return columns


def repeated(b: Binding) -> dict[str, str]:
    """A second, later-sorting record of every row of the snapshot."""
    columns = snapshot(b)
    columns[b.altered] = f"concat({b.columns[b.altered]}, ' ~ repeated')"
    return columns


def older(b: Binding) -> dict[str, str]:
    """A closed version of every row."""
    return b.columns | {b.altered: f"concat('former ', {b.columns[b.altered]})"}


# Events in the shape of the raw log. Purchases are checkouts with 0 to 3 cart lines.
LOGS = {
    "log_id": "CAST(event_id AS string)",
    "user_id": "CAST(user_id AS string)",
    "timestamp": "CAST(ts AS string)",
    "event_type": "CASE event_type WHEN 'purchase' THEN 'checkout' WHEN 'view' THEN 'product_view' "
    "WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN NULL ELSE event_type END",
    "product_id": "CASE WHEN event_type IN ('view', 'click') THEN CAST(k AS string) END",
    "category": "CASE WHEN event_type = 'purchase' THEN NULL ELSE concat('Category ', CAST(k % 10 AS string)) END",
    "quantity": "CASE WHEN event_type = 'click' THEN k % 5 + 1 END",
    "price": "CASE WHEN event_type IN ('view', 'click') THEN value END",
    "total_amount": "CASE WHEN event_type = 'purchase' THEN value * 3 END",
}
PRODUCTS = {"product_id": "CAST(p_partkey AS string)", "name": "p_name", "category": "p_brand", "description": "p_type"}


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS int) AS k")
    cart = (
        "CASE WHEN event_type = 'purchase' AND k % 4 > 0 THEN transform(sequence(1, k % 4), "
        "i -> struct(CAST(k * i AS string) AS product_id, i AS quantity, value AS price)) "
        "WHEN event_type = 'purchase' THEN array() END"
    )
    return derive(events, LOGS | {"cart_items": cart})


LOGS_SQL = f"""SELECT {select_list(LOGS)}, event_type AS kind, k, value
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS int) AS k FROM events)"""

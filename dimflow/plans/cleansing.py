"""Cleansing, de-duplication, profiling and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow import storage
from dimflow.entities import CUSTOMER
from dimflow.functions.rules import CUSTOMER_ID_UNIQUE, customer_rules
from dimflow.operators.cleanse import cleanse_customers as cleanse
from dimflow.operators.cleanse import prepare
from dimflow.operators.dedup import dedup_by_key as keep_first
from dimflow.operators.dedup import remove_duplicates
from dimflow.operators.lookup import flag_unique
from dimflow.operators.profile import flag_email as email_flag
from dimflow.operators.profile import flag_phone as phone_flag
from dimflow.operators.profile import null_nan_profile as profile
from dimflow.operators.quality import load_validated, read_split, rule_report, split, validate, write_split
from dimflow.plans.base import load, query
from dimflow.plans.inputs import AS_OF, PEOPLE_SQL, derive, people, select_list

# Customers to cleanse: every customer twice, the second copy sorting after or before the first.
_RAW = {
    "customer_id": "CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE c_custkey END",
    "first_name": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END",
    "last_name": "c_name",
    "address": "concat('Nation ', CAST(c_nationkey AS string))",
    "balance": "c_acctbal",
}
_COPY = _RAW | {"first_name": "CASE WHEN c_custkey % 6 = 0 THEN concat('A ', c_mktsegment) ELSE concat('Z ', c_mktsegment) END"}
_RAW_SQL = f"SELECT {select_list(_RAW)} FROM customer UNION ALL SELECT {select_list(_COPY)} FROM customer"
_ORDER = "first_name NULLS FIRST, last_name NULLS FIRST, address NULLS FIRST, balance NULLS FIRST"


def _raw(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    return derive(customer, _RAW).unionByName(derive(customer, _COPY))


@query(f"""
    SELECT customer_id, address, balance, concat(first_name, ' ', last_name) AS full_name
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {_ORDER}) AS rn FROM ({_RAW_SQL}) r) t
    WHERE rn = 1 AND customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL AND address IS NOT NULL
""")
def cleanse_customers(spark, sf_dir):
    return cleanse(_raw(spark, sf_dir))


@query(f"""
    SELECT customer_id, address, balance, concat(first_name, ' ', last_name) AS full_name
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {_ORDER}) AS rn FROM ({_RAW_SQL}) r
          WHERE customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL AND address IS NOT NULL) t
    WHERE rn = 1
""")
def cleanse_customers_nulls_first(spark, sf_dir):
    return cleanse(_raw(spark, sf_dir), drop_nulls_first=True)


_LINE_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
)


@query(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn FROM lineitem
    ) t WHERE rn = 1
""")
def dedup_by_key(spark, sf_dir):
    return keep_first(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {_LINE_ORDER}) AS rn FROM lineitem
    ) t WHERE rn = 1
""")
def dedup_latest(spark, sf_dir):
    return keep_first(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedup_rows(spark, sf_dir):
    return remove_duplicates(load(spark, sf_dir, "events").select("user_id", "event_type"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS is_unique
    FROM lineitem
""")
def duplicate_groups(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return flag_unique(lines, ["l_orderkey", "l_linenumber"], "is_unique")


_PREPARED = {
    "customer_id": "CAST(c_custkey AS string)",
    "first_name": "nullif(c_mktsegment, 'MACHINERY')",
    "last_name": "c_name",
    "address": "CASE WHEN c_nationkey = 7 THEN NULL ELSE concat('Nation ', CAST(c_nationkey AS string)) END",
}


@query(f"""
    SELECT *, TIMESTAMP '{AS_OF}' AS insert_date, TIMESTAMP '{AS_OF}' AS update_date
    FROM (SELECT {select_list(_PREPARED)} FROM customer) t
    WHERE address IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
""")
def prepare_required(spark, sf_dir):
    return prepare(derive(load(spark, sf_dir, "customer"), _PREPARED), CUSTOMER, AS_OF)


_PROFILED = {
    "event_id": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id END",
    "ts": "ts",
    "event_type": "nullif(event_type, 'error')",
    "value": "CASE WHEN event_id % 5 = 0 THEN CAST('NaN' AS double) WHEN event_id % 3 = 0 THEN NULL ELSE value END",
}


@query(
    f"WITH e AS (SELECT {select_list(_PROFILED)} FROM events)"
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS bigint) AS null_count,
        CAST({"count(*) FILTER (WHERE isnan(value))" if c == "value" else 0} AS bigint) AS nan_count FROM e"""
        for c in _PROFILED
    )
)
def null_nan_profile(spark, sf_dir):
    return profile(derive(load(spark, sf_dir, "events"), _PROFILED))


EMAIL = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"


@query(f"SELECT *, coalesce(regexp_matches(email, '{EMAIL}'), false) AS email_valid FROM ({PEOPLE_SQL}) p")
def flag_email(spark, sf_dir):
    return email_flag(people(spark, sf_dir), "email")


@query(f"""
    SELECT *, coalesce(regexp_matches(phone_number, '^\\+?[1-9]\\d{{1,14}}$'), false) AS phone_valid FROM ({PEOPLE_SQL}) p
""")
def flag_phone_e164(spark, sf_dir):
    return phone_flag(people(spark, sf_dir), "phone_number")


@query(f"""
    SELECT *, coalesce(length(replace(replace(replace(phone_number, '+', ''), '-', ''), ' ', '')) BETWEEN 7 AND 15, false)
        AS phone_valid FROM ({PEOPLE_SQL}) p
""")
def flag_phone_length(spark, sf_dir):
    return phone_flag(people(spark, sf_dir), "phone_number", method="length")


_DOB = "TRY_CAST(regexp_replace(regexp_replace(date_of_birth, '-(\\d)-', '-0\\1-'), '-(\\d)$', '-0\\1') AS date)"
_FLAGS = f"""
    people AS ({PEOPLE_SQL}),
    typed AS (SELECT *, {_DOB} AS born, TRY_CAST(age AS bigint) AS years, TIMESTAMP '{AS_OF}' AS now FROM people),
    flagged AS (
        SELECT customer_id, full_name, email, age, date_of_birth, phone_number, country,
            coalesce(TRY_CAST(customer_id AS bigint) > 0, false) AS customer_id_valid,
            coalesce(regexp_matches(full_name, '^[A-Za-z ]+$'), false) AS full_name_valid,
            coalesce(regexp_matches(email, '{EMAIL}'), false) AS email_valid,
            coalesce(years BETWEEN 1 AND 120, false) AS age_valid,
            coalesce(CAST(born AS timestamp) < now AND year(born) > 1900, false) AS dob_valid,
            coalesce(regexp_matches(phone_number, '^[0-9]{{10}}$'), false) AS phone_valid,
            coalesce(country IN ('USA', 'UK', 'India', 'Canada', 'Australia', 'Ireland'), false) AS country_valid,
            customer_id IS NOT NULL AND full_name IS NOT NULL AND email IS NOT NULL AND age IS NOT NULL
                AND date_of_birth IS NOT NULL AND phone_number IS NOT NULL AND country IS NOT NULL AS not_null,
            count(*) OVER (PARTITION BY full_name, date_of_birth) = 1 AS no_duplicates,
            coalesce(abs(year(now) - year(born)
                - CASE WHEN (month(now), day(now)) < (month(born), day(born)) THEN 1 ELSE 0 END - years) <= 1, false)
                AS age_consistency
        FROM typed
    ),
    checked AS (
        SELECT *, customer_id_valid AND full_name_valid AND email_valid AND age_valid AND dob_valid AND phone_valid
            AND country_valid AND not_null AND no_duplicates AND age_consistency AS is_valid
        FROM flagged
    )
"""


def _validated(spark, sf_dir):
    return validate(people(spark, sf_dir), customer_rules(AS_OF))


@query(f"WITH {_FLAGS} SELECT * FROM checked")
def validate_flags(spark, sf_dir):
    return _validated(spark, sf_dir)


@query(f"WITH {_FLAGS} SELECT * EXCLUDE (is_valid) FROM checked WHERE is_valid")
def validate_valid(spark, sf_dir):
    return split(_validated(spark, sf_dir))[0]


@query(f"WITH {_FLAGS} SELECT * EXCLUDE (is_valid) FROM checked WHERE NOT is_valid")
def validate_invalid(spark, sf_dir):
    return split(_validated(spark, sf_dir))[1]


_RULES = (
    "customer_id_valid", "full_name_valid", "email_valid", "age_valid", "dob_valid", "phone_valid", "country_valid",
    "not_null", "no_duplicates", "age_consistency", "is_valid",
)


@query(
    f"WITH {_FLAGS} "
    + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, CAST(count(*) FILTER (WHERE {r}) AS bigint) AS passed, "
        f"CAST(count(*) FILTER (WHERE NOT {r}) AS bigint) AS failed FROM checked"
        for r in _RULES
    )
)
def validation_report(spark, sf_dir):
    return rule_report(_validated(spark, sf_dir), customer_rules(AS_OF))


@query(f"WITH {_FLAGS} SELECT * EXCLUDE (is_valid), DATE '2024-06-30' AS load_date FROM checked WHERE NOT is_valid")
def quarantine_sink(spark, sf_dir):
    path = storage.scratch_dir(spark, "quarantine")
    write_split(_validated(spark, sf_dir), path, "2024-06-30")
    return read_split(spark, path)[1]


@query(f"""
    WITH {_FLAGS} SELECT customer_id, full_name, email, age, date_of_birth, phone_number, country FROM checked WHERE is_valid
""")
def validated_load(spark, sf_dir):
    """Two loads of the same rows: the second inserts nothing."""
    root = storage.scratch_dir(spark, "validated")
    for load_date in ("2024-06-30", "2024-07-01"):
        load_validated(
            spark, people(spark, sf_dir), customer_rules(AS_OF), f"{root}/split", f"{root}/dim_customer", load_date,
            ["customer_id"],
        )
    return spark.read.parquet(f"{root}/dim_customer")


@query(f"""
    SELECT customer_id, country, count(*) OVER (PARTITION BY customer_id) = 1 AS customer_id_unique
    FROM (SELECT o_custkey AS customer_id, o_orderstatus AS country FROM orders) o
""")
def customer_id_unique(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").selectExpr("o_custkey AS customer_id", "o_orderstatus AS country")
    return flag_unique(rows, CUSTOMER_ID_UNIQUE.keys, CUSTOMER_ID_UNIQUE.name)

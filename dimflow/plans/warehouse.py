"""Event facts, daily metrics, the claim star, and incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow import storage
from dimflow.entities import ENTITIES
from dimflow.operators.facts import (
    DimRef, build_claim_fact, build_fact_events, explode_carts, with_product_hash,
)
from dimflow.operators.facts import claim_summary as summarise_claims
from dimflow.operators.facts import daily_user_metrics as user_metrics
from dimflow.operators.facts import fk_orphans as orphan_keys
from dimflow.operators.incremental import audit_rows, incremental_extract as extract, run_incremental
from dimflow.operators.lookup import lookup_join
from dimflow.plans.base import load, query
from dimflow.plans.dimensions import versioned_dim
from dimflow.plans.inputs import BINDINGS, LOGS_SQL, PRODUCTS, derive, event_logs, select_list
from dimflow.schemas import AUDIT, EVENT_LOG, conform
from dimflow.sources.tables import write_table

# --- events -------------------------------------------------------------------------------

_LINES = f"""
    logs AS ({LOGS_SQL}),
    lines AS (
        SELECT log_id, user_id, "timestamp", event_type, category, CAST(total_amount AS decimal(14,2)) AS total_amount,
            product_id, CAST(quantity AS decimal(10,2)) AS quantity, CAST(price AS decimal(12,2)) AS unit_price
        FROM logs WHERE event_type IS DISTINCT FROM 'checkout'
        UNION ALL
        SELECT log_id, user_id, "timestamp", event_type, category, CAST(total_amount AS decimal(14,2)),
            CAST(k * i AS string), CAST(i AS decimal(10,2)), CAST(value AS decimal(12,2))
        FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM logs WHERE event_type = 'checkout') c
    ),
    empty_carts AS (
        SELECT log_id, user_id, "timestamp", event_type, category, CAST(total_amount AS decimal(14,2)) AS total_amount,
            CAST(NULL AS string) AS product_id, CAST(NULL AS decimal(10,2)) AS quantity,
            CAST(NULL AS decimal(12,2)) AS unit_price
        FROM logs WHERE event_type = 'checkout' AND k % 4 = 0
    ),
    products AS (SELECT {select_list(PRODUCTS)} FROM part)
"""


def _fact_sql(lines: str) -> str:
    return f"""SELECT log_id, user_id, CAST(CAST("timestamp" AS timestamp) AS date) AS event_date,
        CAST("timestamp" AS timestamp) AS event_timestamp, event_type, l.product_id,
        CASE WHEN p.product_id IS NOT NULL THEN sha256(p.product_id) END AS product_id_hash,
        CASE WHEN event_type = 'checkout' THEN p.category ELSE l.category END AS category, quantity, unit_price,
        CASE WHEN event_type = 'checkout' THEN CAST(quantity * unit_price AS decimal(14,2)) ELSE total_amount END
            AS total_amount,
        CASE WHEN event_type = 'checkout' THEN total_amount END AS cart_total
    FROM ({lines}) l LEFT JOIN products p ON l.product_id = p.product_id"""


def _products(spark, sf_dir):
    return with_product_hash(derive(load(spark, sf_dir, "part"), PRODUCTS))


@query(f"WITH {_LINES} SELECT * FROM lines")
def cart_explode(spark, sf_dir):
    lines = explode_carts(conform(event_logs(spark, sf_dir), EVENT_LOG))
    return lines.withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)"))


@query(f"WITH {_LINES} {_fact_sql('SELECT * FROM lines')}")
def fact_events(spark, sf_dir):
    return build_fact_events(event_logs(spark, sf_dir), _products(spark, sf_dir))


@query(f"WITH {_LINES} {_fact_sql('SELECT * FROM lines UNION ALL SELECT * FROM empty_carts')}")
def fact_events_keep_empty_carts(spark, sf_dir):
    return build_fact_events(event_logs(spark, sf_dir), _products(spark, sf_dir), keep_empty_carts=True)


# The event type dimension: one key per type found in the events.
_EVENT_TYPES_SQL = "SELECT CAST(min(event_id) AS int) + 1 AS event_type_key, event_type AS event_type_name FROM events GROUP BY event_type"


def event_types(spark, sf_dir):
    keys = load(spark, sf_dir, "events").groupBy("event_type").agg(F.min("event_id").alias("first"))
    return keys.selectExpr("CAST(first AS int) + 1 AS event_type_key", "event_type AS event_type_name")


_EVENT_FACT = {
    "log_id": "event_id",
    "user_id": "user_id",
    "event_date": "CAST(ts AS date)",
    "event_type": "event_type",
    "quantity": "CAST(k AS decimal(10,2))",
    "unit_price": "CAST(value AS decimal(12,2))",
    "total_amount": "CAST(value * k AS decimal(14,2))",
}


def event_fact(spark, sf_dir):
    events = load(spark, sf_dir, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS int) AS k")
    return derive(events, _EVENT_FACT)


def _as_doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("total_quantity", "unit_price", "total_amount")})


# The average of cents is rounded half up at six decimals, in whole numbers.
_METRICS_SQL = f"""
    WITH f AS (
        SELECT {select_list(_EVENT_FACT)}
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS int) AS k FROM events) e
    ), m AS (
        SELECT user_id, event_date, count(DISTINCT log_id) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS bought,
            sum(quantity) FILTER (WHERE event_type = 'purchase') AS q,
            CAST(sum(unit_price) FILTER (WHERE event_type = 'purchase') * 100 AS hugeint) AS cents,
            sum(total_amount) FILTER (WHERE event_type = 'purchase') AS amount
        FROM f GROUP BY user_id, event_date
    )
    SELECT user_id, n AS count_of_logid, event_date,
        CASE WHEN bought > 0 THEN (SELECT event_type_key FROM ({_EVENT_TYPES_SQL}) WHERE event_type_name = 'purchase') END
            AS event_type_key,
        CAST(coalesce(q, 0) AS double) AS total_quantity,
        coalesce(CAST((cents * 20000 + bought) // (2 * bought) AS double) / 1000000, 0) AS unit_price,
        CAST(coalesce(amount, 0) AS double) AS total_amount
    FROM m
"""


@query(_METRICS_SQL)
def daily_user_metrics(spark, sf_dir):
    return _as_doubles(user_metrics(event_fact(spark, sf_dir), event_types(spark, sf_dir), checkout="purchase"))


@query(_METRICS_SQL)
def daily_user_metrics_sorted(spark, sf_dir):
    metrics = user_metrics(event_fact(spark, sf_dir), event_types(spark, sf_dir), checkout="purchase", sort=True)
    return _as_doubles(metrics)


_LOOKUP_SQL = f"""
    SELECT event_id, user_id, event_type, event_type_key FROM events LEFT JOIN ({_EVENT_TYPES_SQL}) t
    ON event_type = event_type_name
"""


@query(_LOOKUP_SQL)
def event_type_lookup(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    types = event_types(spark, sf_dir)
    return lookup_join(events, types, {"event_type": "event_type_name"}, {"event_type_key": "event_type_key"})


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name, p_brand
    FROM (SELECT *, CASE WHEN l_linenumber <= 2 THEN CAST(1 AS bigint) WHEN l_linenumber = 3 THEN NULL ELSE l_partkey END AS pk
          FROM lineitem) l
    LEFT JOIN part ON pk = p_partkey
""")
def skewed_lookup(spark, sf_dir):
    """A lookup where one key and NULL hold much of the fact; adaptive execution splits them."""
    key = "CASE WHEN l_linenumber <= 2 THEN CAST(1 AS bigint) WHEN l_linenumber = 3 THEN NULL ELSE l_partkey END AS pk"
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", key
    )
    part = load(spark, sf_dir, "part")
    return lookup_join(lines, part, {"pk": "p_partkey"}, {"p_name": "p_name", "p_brand": "p_brand"}).drop("pk")


# --- claims -------------------------------------------------------------------------------

# Order lines as claims; a part of the customer and region keys refers to nothing.
_CLAIMS = {
    "claim_id": "concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string), '-', CAST(l_partkey AS string))",
    "customer_id": "CAST(l_orderkey AS string)",
    "policy_id": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE CAST(l_orderkey AS string) END",
    "provider_id": "CAST(l_suppkey AS string)",
    "region_id": "CAST(CAST(l_quantity AS int) AS string)",
    "claim_date": "CAST(l_shipdate AS date)",
    "claim_type": "l_returnflag",
    "claim_status": "l_linestatus",
    "claim_amount": "CAST(l_extendedprice AS decimal(14,2))",
    "submission_channel": "l_linestatus",
    "inserted_at": "l_shipdate",
    "approved_amount": "CAST(CAST(l_extendedprice AS decimal(14,2)) * (1 - CAST(l_discount AS decimal(4,2))) AS decimal(14,2))",
}
_STAR = (("customer", "state", "customer_state"), ("policy", "policy_type", "policy_type"),
         ("provider", "type", "provider_type"), ("region", "zone", "region_zone"))
_STAR_SQL = (
    f"""WITH claims AS (SELECT {select_list(_CLAIMS)} FROM lineitem), """
    + ", ".join(
        f"{name} AS (SELECT {select_list(BINDINGS[name].columns)} FROM {BINDINGS[name].table})" for name, _, _ in _STAR
    )
    + """, star AS (SELECT c.*, """
    + ", ".join(
        f"{name}.{attribute} AS {out}, c.{name}_id IS NOT NULL AND {name}.{name}_id IS NULL AS {name}_orphan"
        for name, attribute, out in _STAR
    )
    + " FROM claims c "
    + " ".join(f"LEFT JOIN {name} ON c.{name}_id = {name}.{name}_id" for name, _, _ in _STAR)
    + ")"
)


@query(f"{_STAR_SQL} SELECT * FROM star")
def claim_fact(spark, sf_dir):
    claims = derive(load(spark, sf_dir, "lineitem"), _CLAIMS)
    dims = {name: versioned_dim(spark, sf_dir, BINDINGS[name], ENTITIES[name]) for name, _, _ in _STAR}
    return build_claim_fact(claims, dims["customer"], dims["policy"], dims["provider"], dims["region"])


@query(f"""{_STAR_SQL}
    SELECT provider_type, claim_type, claim_status, CAST(grouping_id(provider_type, claim_type, claim_status) AS int) AS level,
        count(*) AS claims, CAST(sum(claim_amount) AS double) AS claimed, CAST(sum(approved_amount) AS double) AS approved
    FROM star GROUP BY ROLLUP (provider_type, claim_type, claim_status)
""")
def claim_summary(spark, sf_dir):
    claims = derive(load(spark, sf_dir, "lineitem"), _CLAIMS)
    providers = versioned_dim(spark, sf_dir, BINDINGS["provider"], ENTITIES["provider"])
    lookup = DimRef("provider", providers, "provider_id", "provider_id", {"type": "provider_type"})
    summary = summarise_claims(claims, ["provider_type", "claim_type", "claim_status"], [lookup])
    return summary.withColumns({c: F.col(c).cast("double") for c in ("claimed", "approved")})


@query("""
    SELECT l_partkey, count(*) AS row_count FROM lineitem
    WHERE l_partkey NOT IN (SELECT CASE WHEN p_size > 45 THEN -p_partkey - 1 ELSE p_partkey END FROM part)
    GROUP BY l_partkey
""")
def fk_orphans(spark, sf_dir):
    part = load(spark, sf_dir, "part").selectExpr("CASE WHEN p_size > 45 THEN -p_partkey - 1 ELSE p_partkey END AS p_partkey")
    return orphan_keys(load(spark, sf_dir, "lineitem"), part, "l_partkey", "p_partkey")


@query("""
    SELECT CAST(o_custkey AS string) AS customer_id, count(*) AS row_count FROM orders
    WHERE o_custkey NOT IN (SELECT CASE WHEN c_custkey % 7 = 0 THEN -c_custkey - 1 ELSE c_custkey END FROM customer)
    GROUP BY o_custkey
""")
def vehicle_owner_orphans(spark, sf_dir):
    vehicle = derive(load(spark, sf_dir, "orders"), BINDINGS["vehicle"].columns)
    owners = load(spark, sf_dir, "customer").selectExpr(
        "CAST(CASE WHEN c_custkey % 7 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS string) AS customer_id"
    )
    return orphan_keys(vehicle, owners, "customer_id", "customer_id")


# --- incremental loads --------------------------------------------------------------------

# Audit trail: the job's last run covered fulfilled orders up to 1998; another job is further on.
_AUDIT_SQL = """
    SELECT 'orders' AS jobname, CAST(year(o_orderdate) AS string) AS runid, max(o_orderdate) AS lastrundate
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00' GROUP BY year(o_orderdate)
    UNION ALL SELECT 'invoices', 'all', max(o_orderdate) FROM orders
"""


def _audit(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    runs = (
        orders.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'")
        .groupBy(F.year("o_orderdate").cast("string").alias("runid"))
        .agg(F.max("o_orderdate").alias("lastrundate"))
        .withColumn("jobname", F.lit("orders"))
    )
    other = orders.agg(F.max("o_orderdate").alias("lastrundate")).withColumns(
        {"jobname": F.lit("invoices"), "runid": F.lit("all")}
    )
    return conform(runs.unionByName(other), AUDIT)


@query(f"""
    WITH audit AS ({_AUDIT_SQL})
    SELECT * FROM orders WHERE o_orderdate > (SELECT max(lastrundate) FROM audit WHERE jobname = 'orders')
""")
def incremental_extract(spark, sf_dir):
    return extract(load(spark, sf_dir, "orders"), _audit(spark, sf_dir), "orders", "o_orderdate")


@query("SELECT * FROM orders")
def incremental_full_load(spark, sf_dir):
    return extract(load(spark, sf_dir, "orders"), _audit(spark, sf_dir), "shipments", "o_orderdate")


@query(f"""
    WITH audit AS ({_AUDIT_SQL})
    SELECT * FROM audit UNION ALL
    SELECT 'orders', 'next', max(o_orderdate) FROM orders
    WHERE o_orderdate > (SELECT max(lastrundate) FROM audit WHERE jobname = 'orders')
""")
def audit_append(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    loaded = extract(load(spark, sf_dir, "orders"), audit, "orders", "o_orderdate")
    trail = audit.unionByName(audit_rows(loaded, "orders", "next", "o_orderdate"))
    return trail.withColumn("lastrundate", F.col("lastrundate").cast("timestamp_ntz"))


# A seventh of the orders has no stamp.
_STAMP = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END"


@query(f"""
    WITH audit AS ({_AUDIT_SQL}),
    source AS (SELECT * REPLACE ({_STAMP} AS o_orderdate) FROM orders),
    r1 AS (SELECT * FROM source WHERE o_orderkey % 3 <> 0 AND (o_orderdate IS NULL
        OR o_orderdate >= (SELECT max(lastrundate) FROM audit WHERE jobname = 'orders')))
    SELECT *, 'r1' AS run_id FROM r1 UNION ALL
    SELECT *, 'r2' FROM source WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r1)
        AND (o_orderdate IS NULL OR o_orderdate >= (SELECT max(o_orderdate) FROM r1))
""")
def incremental_run(spark, sf_dir):
    """Three runs of the job: rows with the mark's stamp or none arrive late, and the third finds nothing new."""
    root = storage.scratch_dir(spark, "increment")
    write_table(_audit(spark, sf_dir), "parquet", {"path": f"{root}/audit"})
    orders = load(spark, sf_dir, "orders").withColumn("o_orderdate", F.expr(_STAMP))
    for run_id, arrived in (("r1", orders.where("o_orderkey % 3 <> 0")), ("r2", orders), ("r3", orders)):
        run_incremental(
            spark, arrived, f"{root}/audit", f"{root}/orders", "orders", run_id, "o_orderdate", keys=["o_orderkey"]
        )
    return spark.read.parquet(f"{root}/orders")

"""Fact tables and the aggregates reported from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from dimflow import schemas
from dimflow.operators.lookup import lookup_join
from dimflow.schemas import conform, require_columns

CHECKOUT = "checkout"


def with_product_hash(products: DataFrame) -> DataFrame:
    """Product dimension with its ``product_id_hash`` key."""
    return products.withColumn("product_id_hash", F.sha2("product_id", 256))


def explode_carts(logs: DataFrame, keep_empty_carts: bool = False) -> DataFrame:
    """One row per cart line of a checkout and one per other event, in a single pass.

    Other events (including those without a type) become a one-line cart of their own
    columns, so both kinds take the same explode. A checkout with no cart lines is
    dropped, or kept with NULL line columns when ``keep_empty_carts``.
    """
    line_type = ArrayType(schemas.CART_LINE)
    is_checkout = F.col("event_type").eqNullSafe(CHECKOUT)
    own_line = F.array(F.struct("product_id", "quantity", "price"))
    lines = F.when(is_checkout, F.col("cart_items").try_cast(line_type)).otherwise(own_line.try_cast(line_type))
    explode = F.explode_outer if keep_empty_carts else F.explode
    return logs.select(
        "log_id", "user_id", "timestamp", "event_type", "category", "total_amount", explode(lines).alias("line")
    ).select(
        "log_id", "user_id", "timestamp", "event_type", "category", "total_amount",
        "line.product_id", "line.quantity", F.col("line.price").alias("unit_price"),
    )


def build_fact_events(logs: DataFrame, products: DataFrame, keep_empty_carts: bool = False) -> DataFrame:
    """Event fact: one row per event or cart line, with its product's hash key.

    The category of a checkout line comes from the product, that of any other event
    from the event. ``total_amount`` of a checkout line is quantity x unit price, so it
    adds up over lines; the amount logged for the whole cart is ``cart_total``.
    """
    require_columns(logs, ["timestamp"])
    lines = explode_carts(conform(logs, schemas.EVENT_LOG), keep_empty_carts)
    fact = lookup_join(
        lines, products, {"product_id": "product_id"},
        {"product_id_hash": "product_id_hash", "category": "product_category"},
    )
    at = F.try_to_timestamp(F.col("timestamp"))
    is_checkout = F.col("event_type").eqNullSafe(CHECKOUT)
    return conform(
        fact.select(
            "log_id", "user_id",
            F.to_date(at).alias("event_date"),
            at.cast("timestamp_ntz").alias("event_timestamp"),
            "event_type", "product_id", "product_id_hash",
            F.when(is_checkout, F.col("product_category")).otherwise(F.col("category")).alias("category"),
            "quantity", "unit_price",
            F.when(is_checkout, F.col("quantity") * F.col("unit_price")).otherwise(F.col("total_amount")).alias("total_amount"),
            F.when(is_checkout, F.col("total_amount")).alias("cart_total"),
        ),
        schemas.FACT_USER_EVENTS,
    )


def daily_user_metrics(
    fact: DataFrame, event_types: DataFrame, checkout: str = CHECKOUT, sort: bool = False
) -> DataFrame:
    """Per user and day: distinct log entries, and what was checked out.

    Log entries and checkouts are aggregated apart: the distinct count needs a shuffle
    that spreads a busy user over its entries, and this way carries nothing else. Each
    scan reads only its own columns, and the second one only checkouts. The two meet in
    a grouping, not a join, as NULL users and dates are groups too.
    """
    keys = ["user_id", "event_date"]
    measures = ["total_quantity", "unit_price", "total_amount"]
    entries = fact.groupBy(*keys).agg(F.count_distinct("log_id").alias("count_of_logid"))
    bought = fact.where(F.col("event_type") == checkout).groupBy(*keys).agg(
        F.lit(True).alias("bought"),
        F.sum("quantity").alias("total_quantity"),
        F.avg("unit_price").alias("unit_price"),
        F.sum("total_amount").alias("total_amount"),
    )
    daily = entries.unionByName(bought, allowMissingColumns=True).groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in ("count_of_logid", "bought", *measures))
    )
    checkout_key = event_types.where(F.col("event_type_name") == checkout).agg(F.max("event_type_key")).scalar()
    metrics = daily.select(
        "user_id",
        "count_of_logid",
        "event_date",
        F.when(F.col("bought"), checkout_key).alias("event_type_key"),
        *measures,
    ).na.fill(0, subset=measures)
    return metrics.orderBy(*keys) if sort else metrics


@dataclass(frozen=True)
class DimRef:
    """How a fact refers to a dimension."""

    name: str
    dim: DataFrame
    foreign_key: str
    key: str
    attributes: Mapping[str, str] = field(default_factory=dict)
    active: str = "is_active"


def build_star(fact: DataFrame, refs: Sequence[DimRef]) -> DataFrame:
    """``fact`` with the attributes of its current dimension rows.

    Of several active rows of a key, or rows of a dimension without versions, one counts.
    ``<name>_orphan`` is True where a foreign key has no current row; a NULL foreign key
    refers to nothing and is not an orphan.
    """
    columns = list(fact.columns)
    star = fact
    for ref in refs:
        dim = ref.dim.where(ref.active) if ref.active in ref.dim.columns else ref.dim
        found = f"__{ref.name}_found"
        star = lookup_join(
            star, dim.select(ref.key, *ref.attributes, F.lit(True).alias(found)),
            {ref.foreign_key: ref.key}, {**ref.attributes, found: found},
        )
        columns += [*ref.attributes.values(), f"{ref.name}_orphan"]
        star = star.withColumn(f"{ref.name}_orphan", F.col(ref.foreign_key).isNotNull() & F.col(found).isNull())
    return star.select(*columns)


def build_claim_fact(
    claims: DataFrame, customers: DataFrame, policies: DataFrame, providers: DataFrame, regions: DataFrame
) -> DataFrame:
    """Insurance claims joined to the current customer, policy, provider and region."""
    return build_star(
        claims,
        [
            DimRef("customer", customers, "customer_id", "customer_id", {"state": "customer_state"}),
            DimRef("policy", policies, "policy_id", "policy_id", {"policy_type": "policy_type"}),
            DimRef("provider", providers, "provider_id", "provider_id", {"type": "provider_type"}),
            DimRef("region", regions, "region_id", "region_id", {"zone": "region_zone"}),
        ],
    )


def claim_summary(
    claims: DataFrame,
    by: Sequence[str],
    lookups: Sequence[DimRef] = (),
    claimed: str = "claim_amount",
    approved: str = "approved_amount",
) -> DataFrame:
    """Claim counts and amounts per ``by``, with the subtotals of each drill-down level.

    ``by`` may name attributes of ``lookups``. Claims are summed per foreign key and own column
    first, so attributes are joined to groups and the roll-up multiplies groups, not claims.
    """
    looked_up = {out for ref in lookups for out in ref.attributes.values()}
    own = [c for c in by if c not in looked_up]
    groups = claims.groupBy(*dict.fromkeys([*own, *(ref.foreign_key for ref in lookups)])).agg(
        F.count(F.lit(1)).alias("claims"), F.sum(claimed).alias("claimed"), F.sum(approved).alias("approved")
    )
    kinds = groups.schema
    groups = build_star(groups, lookups)
    totals = groups.rollup(*by).agg(
        F.grouping_id().cast("int").alias("level"), *(F.sum(c).alias(c) for c in ("claims", "claimed", "approved"))
    )
    return totals.withColumns({c: F.col(c).cast(kinds[c].dataType) for c in ("claims", "claimed", "approved")})


def fk_orphans(fact: DataFrame, dim: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """Foreign key values without a dimension row, and how many rows carry each.

    The fact is counted per key first, so the anti join sees each value once.
    """
    counts = fact.where(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count(F.lit(1)).alias("row_count"))
    keys = dim.select(F.col(key).alias(foreign_key)).distinct()
    return counts.join(keys, foreign_key, "left_anti")

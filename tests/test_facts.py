import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimflow.operators.facts import (
    DimRef, build_claim_fact, build_fact_events, build_star, claim_summary, daily_user_metrics, explode_carts, fk_orphans,
    with_product_hash,
)
from dimflow.schemas import CLAIM, EVENT_LOG, EVENT_TYPE, FACT_USER_EVENTS, PRODUCT_DETAILS
from dimflow.sources.tables import read_json
from tests.conftest import rows

LOGS = [
    dict(log_id="1", user_id="u1", timestamp="2025-08-01T09:00:00Z", event_type="product_view", product_id="p1", category="Toys", price=9.99),
    dict(log_id="2", user_id="u1", timestamp="2025-08-01T09:05:00Z", event_type="add_to_cart", product_id="p1", category="Toys", price=9.99, quantity=2),
    dict(log_id="3", user_id="u1", timestamp="2025-08-01T23:59:59Z", event_type="checkout", total_amount=39.98,
         cart_items=[dict(product_id="p1", quantity=2, price=9.99), dict(product_id="p2", quantity=1, price=20.0)]),
    dict(log_id="4", user_id="u2", timestamp="2025-08-02T00:00:00Z", event_type="checkout", total_amount=0.0, cart_items=[]),
    dict(log_id="5", user_id="u2", timestamp="not a time", event_type=None, product_id="p9", category="Misc"),
]


@pytest.fixture
def logs(spark, tmp_path):
    (tmp_path / "logs.json").write_text(json.dumps(LOGS, indent=2))
    return read_json(spark, str(tmp_path / "logs.json"), EVENT_LOG, multi_line=True)


@pytest.fixture
def products(spark):
    data = [("p1", "Top", "Games", ""), ("p2", "Mug", "Kitchen", "")]
    return with_product_hash(spark.createDataFrame(data, PRODUCT_DETAILS))


@pytest.fixture
def event_types(spark):
    return spark.createDataFrame([(10, "product_view", ""), (30, "checkout", "")], EVENT_TYPE)


def test_carts_are_flattened_in_one_scan(spark, logs):
    lines = explode_carts(logs)
    assert rows(lines, "log_id", "product_id", "quantity") == [
        ("1", "p1", None), ("2", "p1", Decimal("2.00")), ("3", "p1", Decimal("2.00")), ("3", "p2", Decimal("1.00")), ("5", "p9", None)
    ]
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_empty_carts_can_be_kept(logs, products):
    assert rows(build_fact_events(logs, products).where("log_id = '4'")) == []
    kept = build_fact_events(logs, products, keep_empty_carts=True).where("log_id = '4'").first()
    assert kept.product_id is None and kept.cart_total == Decimal("0.00")


def test_fact_follows_its_declared_schema(logs, products):
    fact = build_fact_events(logs, products)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT_USER_EVENTS]
    view = fact.where("log_id = '1'").first()
    assert view.event_date == date(2025, 8, 1) and view.event_timestamp == datetime(2025, 8, 1, 9)
    assert view.category == "Toys" and len(view.product_id_hash) == 64


def test_checkout_takes_category_from_product_and_amount_from_line(logs, products):
    assert rows(build_fact_events(logs, products).where("event_type = 'checkout'"), "product_id", "category", "total_amount", "cart_total") == [
        ("p1", "Games", Decimal("19.98"), Decimal("39.98")), ("p2", "Kitchen", Decimal("20.00"), Decimal("39.98"))
    ]


def test_event_without_type_or_time_or_product_is_kept(logs, products):
    odd = build_fact_events(logs, products).where("log_id = '5'").first()
    assert (odd.event_type, odd.event_date, odd.product_id_hash, odd.category) == (None, None, None, "Misc")


def test_timestamp_column_is_required(logs, products):
    with pytest.raises(ValueError, match="timestamp"):
        build_fact_events(logs.drop("timestamp"), products)


def test_fact_is_the_same_when_products_are_not_broadcast(logs, products, no_broadcast):
    assert build_fact_events(logs, products).count() == 5
    assert rows(build_fact_events(logs, products), "log_id", "category")[2:4] == [("3", "Games"), ("3", "Kitchen")]


def test_daily_metrics(logs, products, event_types):
    metrics = daily_user_metrics(build_fact_events(logs, products), event_types, sort=True)
    assert metrics.columns == [
        "user_id", "count_of_logid", "event_date", "event_type_key", "total_quantity", "unit_price", "total_amount"
    ]
    assert [tuple(r) for r in metrics.collect()] == [
        ("u1", 3, date(2025, 8, 1), 30, Decimal("3.00"), Decimal("14.995000"), Decimal("39.98")),
        ("u2", 1, None, None, Decimal("0.00"), Decimal("0.000000"), Decimal("0.00")),
    ]


def test_daily_metrics_without_a_checkout_key(logs, products, event_types):
    metrics = daily_user_metrics(build_fact_events(logs, products), event_types.where("event_type_key = 10"))
    assert rows(metrics, "event_type_key") == [(None,), (None,)]


def test_daily_metrics_errors_are_raised(spark, logs, products, event_types):
    fact = build_fact_events(logs, products)
    with pytest.raises(Exception, match="log_id"):
        daily_user_metrics(fact.drop("log_id"), event_types)
    failing = fact.withColumn("quantity", F.raise_error(F.lit("bad row")).cast("decimal(10,2)"))
    with pytest.raises(Exception, match="bad row"):
        daily_user_metrics(failing, event_types).collect()


def claims(spark, *data):
    names = ("claim_id", "customer_id", "policy_id", "provider_id", "region_id", "claim_type", "claim_status", "claim_amount", "approved_amount")
    made = spark.createDataFrame(list(data), ", ".join(f"{n} string" for n in names))
    return made.select(*(F.col(f.name).cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in CLAIM))


def test_claim_star_uses_current_rows_and_marks_orphans(spark):
    dim = lambda key, attribute, *data: spark.createDataFrame(list(data), f"{key} string, {attribute} string, is_active boolean")
    facts = claims(
        spark,
        ("1", "C1", "P1", "V1", "R1", "Auto", "Approved", "100.50", "90.00"),
        ("2", "C2", None, "V1", "R9", "Auto", "Rejected", "50.00", "0.00"),
    )
    star = build_claim_fact(
        facts,
        dim("customer_id", "state", ("C1", "old", False), ("C1", "new", True), ("C2", "gone", False)),
        dim("policy_id", "policy_type", ("P1", "Home", True)),
        dim("provider_id", "type", ("V1", "Agent", True)),
        dim("region_id", "zone", ("R1", "West", True)),
    )
    assert rows(star, "claim_id", "customer_state", "customer_orphan", "policy_type", "policy_orphan", "provider_type", "region_orphan") == [
        ("1", "new", False, "Home", False, "Agent", False), ("2", None, True, None, False, "Agent", True)
    ]
    summary = claim_summary(star, ["provider_type", "claim_status"])
    assert rows(summary) == [
        ("Agent", "Approved", 0, 1, Decimal("100.50"), Decimal("90.00")),
        ("Agent", "Rejected", 0, 1, Decimal("50.00"), Decimal("0.00")),
        ("Agent", None, 1, 2, Decimal("150.50"), Decimal("90.00")),
        (None, None, 3, 2, Decimal("150.50"), Decimal("90.00")),
    ]


def test_star_without_broadcast(spark, no_broadcast):
    fact = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS a_id", "id % 7 AS b_id")
    a = spark.range(40).selectExpr("id AS a_key", "id * 10 AS a_value")
    b = spark.range(5).selectExpr("id AS b_key", "id * 100 AS b_value")
    star = build_star(fact, [DimRef("a", a, "a_id", "a_key", {"a_value": "av"}), DimRef("b", b, "b_id", "b_key", {"b_value": "bv"})])
    for r in star.collect():
        assert r.a_orphan == (r.a_id >= 40) and r.av == (None if r.a_id >= 40 else r.a_id * 10)
        assert r.b_orphan == (r.b_id >= 5) and r.bv == (None if r.b_id >= 5 else r.b_id * 100)
    assert star.count() == 1000


def test_orphan_report_counts_rows_per_key(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert rows(fk_orphans(fact, spark.createDataFrame([("a",)], "key string"), "k", "key")) == [("b", 2)]

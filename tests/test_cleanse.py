import pytest
from pyspark.sql import functions as F

from dimflow.entities import CUSTOMER, HOSPITAL
from dimflow.operators.cleanse import cleanse_customers, prepare
from dimflow.operators.dedup import dedup_by_key, remove_duplicates
from tests.conftest import rows

SCHEMA = "customer_id int, first_name string, last_name string, address string, seen int"


def test_cleanse_builds_full_name_and_drops_parts(spark):
    df = spark.createDataFrame([(1, "Ann", "Lee", "Oak St", 1), (2, None, "Ray", "Elm St", 1)], SCHEMA)
    out = cleanse_customers(df)
    assert out.columns == ["customer_id", "address", "seen", "full_name"]
    assert rows(out) == [(1, "Oak St", 1, "Ann Lee")]


def test_duplicates_go_before_incomplete_rows_unless_told_otherwise(spark):
    df = spark.createDataFrame([(1, None, "Lee", "Oak St", 1), (1, "Ann", "Lee", "Oak St", 2)], SCHEMA)
    assert rows(cleanse_customers(df, order_by=["seen"])) == []
    assert rows(cleanse_customers(df, order_by=["seen"], drop_nulls_first=True), "full_name") == [("Ann Lee",)]


def test_missing_input_column(spark):
    with pytest.raises(ValueError, match="address"):
        cleanse_customers(spark.createDataFrame([(1, "a", "b")], "customer_id int, first_name string, last_name string"))


def test_dedup_is_deterministic_and_ordered(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (None, "x", 1), (None, "y", 1)], "k int, v string, n int")
    assert rows(dedup_by_key(df, ["k"])) == [(1, "a", 2), (None, "x", 1)]
    assert rows(dedup_by_key(df, ["k"], [F.desc("n"), F.desc("v")])) == [(1, "b", 2), (None, "y", 1)]
    assert dedup_by_key(df.repartition(7), ["k"]).where("k = 1").first().v == "a"


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = dedup_by_key(spark.range(100).selectExpr("id % 3 AS k", "id AS v"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:], "no limit below the exchange"


def test_dedup_with_nothing_to_order_by(spark):
    assert rows(dedup_by_key(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"])) == [(1,), (2,)]
    maps = spark.sql("SELECT 1 AS k, map('a', 1) AS m UNION ALL SELECT 1, map('a', 1)")
    assert dedup_by_key(maps, ["k"]).count() == 1


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert rows(remove_duplicates(df)) == [(1, "a"), (1, "b")]
    assert rows(remove_duplicates(df, ["k"])) == [(1, "a")]


def test_prepare_filters_on_mandatory_fields_and_stamps(spark):
    df = spark.createDataFrame(
        [("H1", "Mercy", "Oslo", None), ("H2", None, "Oslo", "NABH"), (None, "Hope", "Oslo", "NABH")],
        "hospital_id string, hospital_name string, location string, accreditation string",
    )
    out = prepare(df, HOSPITAL, "2024-05-01 10:00:00")
    assert rows(out, "hospital_id") == [("H1",)]
    assert str(out.first().insert_date) == str(out.first().update_date) == "2024-05-01 10:00:00"


def test_prepare_does_not_require_the_customer_key(spark):
    df = spark.createDataFrame(
        [(None, "Ann", "Lee", "Oak St")], "customer_id string, first_name string, last_name string, address string"
    )
    assert prepare(df, CUSTOMER, "2024-05-01 10:00:00").count() == 1


def test_rows_with_maps_are_distinct_by_their_entries(spark):
    kind = "id int, m map<string, int>, deep struct<list: array<map<int, map<string, string>>>, x: int>"
    data = [
        (1, {"a": 1, "b": None}, ([{1: {"x": "y", "z": None}}], 2)), (1, {"b": None, "a": 1}, ([{1: {"z": None, "x": "y"}}], 2)),
        (1, {"a": 1}, None), (1, {"a": 1}, None), (1, None, None), (1, None, (None, None)), (1, {}, (None, None)), (2, {}, (None, None)),
    ]
    found = remove_duplicates(spark.createDataFrame(data, kind))
    assert found.count() == 6 and found.schema.simpleString() == spark.createDataFrame([], kind).schema.simpleString()

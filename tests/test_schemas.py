from decimal import Decimal

import pytest

from dimflow import schemas
from dimflow.schemas import conform, require_columns
from tests.conftest import rows


def test_conform_orders_types_and_fills(spark):
    df = spark.createDataFrame([("10.129", "x", "P1")], "annual_premium string, extra string, policy_id string")
    out = conform(df, schemas.POLICY)
    assert out.schema == schemas.POLICY or [f.dataType for f in out.schema] == [f.dataType for f in schemas.POLICY]
    row = out.first()
    assert (row.policy_id, row.annual_premium, row.start_date) == ("P1", Decimal("10.13"), None)


def test_conform_turns_bad_values_into_null(spark):
    df = spark.createDataFrame([("V1", "not a year"), ("V2", "2020")], "vehicle_id string, year string")
    assert rows(conform(df, schemas.VEHICLE), "vehicle_id", "year") == [("V1", None), ("V2", 2020)]


def test_missing_column_is_an_error_before_any_job(spark):
    with pytest.raises(ValueError, match="timestamp"):
        require_columns(spark.range(1), ["timestamp"])

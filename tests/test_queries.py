"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from dimflow.plans.base import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield connection
    connection.close()


def value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


def table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([value(row[i]) for i in order] for row in data)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    result = duck.execute(registry.oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == expected
    assert expected[1], "the check must not be vacuous"


def test_flagship(spark):
    assert registry.entry(spark).count() > 0

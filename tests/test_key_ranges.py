import pytest

from dimflow.operators.incremental import insert_ignore
from dimflow.operators.quality import load_validated
from dimflow.functions.rules import Rule
from dimflow.sources.key_ranges import files_holding, index_files, rows_of_files
from pyspark.sql import functions as F
from tests.conftest import rows

SCHEMA = "id long, day string, v string"


@pytest.fixture
def table(spark, tmp_path):
    """Ten files of 100 ids each, the ids of a file close together."""
    path = str(tmp_path / "a table")
    for part in range(10):
        ids = range(100 * part, 100 * part + 100)
        spark.createDataFrame([(i, "d", "old") for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def files_read(df) -> int:
    """Files that the plan's scan opens."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numFiles").value()


def test_only_files_that_may_hold_a_key_are_read(spark, table):
    incoming = spark.createDataFrame([(5, "d", "new"), (707, "d", "new"), (5000, "d", "new"), (None, "d", "new")], SCHEMA)
    kept = rows_of_files(spark, table, incoming, ["id"])
    assert files_read(kept) == 2 and kept.count() == 200
    assert rows(insert_ignore(kept, incoming, ["id"])) == [(5000, "d", "new")]


def test_the_result_is_that_of_reading_all_files(spark, table):
    incoming = spark.range(0, 2000, 37).selectExpr("id", "IF(id % 2 = 0, 'd', 'e') AS day", "'new' AS v")
    every = spark.read.parquet(table)
    for keys in (["id"], ["day", "id"], ["v"]):
        assert rows(insert_ignore(rows_of_files(spark, table, incoming, keys), incoming, keys)) == rows(insert_ignore(every, incoming, keys))


def test_only_new_files_are_indexed(spark, table):
    assert index_files(spark, table, ["id"]).count() == 10
    spark.createDataFrame([(9000, "d", "x"), (None, "d", "x")], SCHEMA).coalesce(1).write.mode("append").parquet(table)
    spark.createDataFrame([(None, "d", "x")], SCHEMA).coalesce(1).write.mode("append").parquet(table)
    found = index_files(spark, table, ["id"])
    assert found.count() == index_files(spark, table, ["id"]).count() == 12
    assert found.where("low IS NULL AND high IS NULL").count() == 1
    assert len(files_holding(spark, table, spark.createDataFrame([(9000, "d", "y")], SCHEMA), ["id"])) == 1


def test_without_table_or_keys(spark, table, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "d", "new")], SCHEMA)
    assert rows_of_files(spark, str(tmp_path / "nowhere"), some, ["id"]).count() == 0
    assert files_holding(spark, table, none, ["id"]) == [] and rows_of_files(spark, table, none, ["id"]).count() == 0


def test_a_rewritten_table_is_indexed_anew(spark, table):
    index_files(spark, table, ["id"])
    spark.createDataFrame([(3, "d", "x")], SCHEMA).coalesce(1).write.mode("overwrite").parquet(table)
    assert [(r.low.id, r.high.id) for r in index_files(spark, table, ["id"]).collect()] == [(3, 3)]


def test_validated_load_by_key_ranges(spark, tmp_path):
    rules = [Rule("small", F.col("id") < 3)]
    for n, date in ((2, "2024-06-14"), (5, "2024-06-15"), (5, "2024-06-15")):
        load_validated(spark, spark.range(n), rules, str(tmp_path / "split"), str(tmp_path / "target"), date, ["id"], key_ranges=True)
    assert rows(spark.read.parquet(str(tmp_path / "target"))) == [(0,), (1,), (2,)]

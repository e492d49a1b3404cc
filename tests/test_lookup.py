import pytest
from pyspark.sql import functions as F

from dimflow.entities import ENTITIES
from dimflow.operators.facts import DimRef, build_star
from dimflow.operators.lookup import flag_unique, lookup_join
from dimflow.plans import warehouse
from tests.conftest import rows


def facts(spark, n=6000):
    """A third of the rows share one key, a sixth have none, some refer to nothing."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 6 = 1 THEN NULL ELSE id % 900 END"
    return spark.range(n).selectExpr("id", f"CAST({key} AS bigint) AS k", "id % 2 AS j")


def dims(spark):
    return spark.range(600).selectExpr("id AS key", "concat('name ', id) AS name", "CASE WHEN id = 7 THEN NULL ELSE id * 2 END AS size")


def expected(spark):
    names = {r.key: (r.name, r.size) for r in dims(spark).collect()}
    return sorted(((r.id, r.k, r.j, *names.get(r.k, (None, None))) for r in facts(spark).collect()), key=repr)


COLUMNS = {"name": "dim_name", "size": "dim_size"}


def test_small_dim(spark):
    assert rows(lookup_join(facts(spark), dims(spark), {"k": "key"}, COLUMNS)) == expected(spark)


def test_large_dim_gives_the_same_rows(spark, no_broadcast):
    assert rows(lookup_join(facts(spark), dims(spark), {"k": "key"}, COLUMNS)) == expected(spark)


def test_empty_sides(spark, no_broadcast):
    assert lookup_join(facts(spark).limit(0), dims(spark), {"k": "key"}, COLUMNS).count() == 0
    assert lookup_join(facts(spark), dims(spark).limit(0), {"k": "key"}, COLUMNS).where("dim_name IS NOT NULL").count() == 0


def test_repeated_dim_keys_do_not_fan_out(spark):
    twice = dims(spark).unionByName(dims(spark).withColumn("name", F.lit("zz")))
    assert rows(lookup_join(facts(spark), twice, {"k": "key"}, COLUMNS)) == expected(spark)


def test_null_dim_key_matches_only_when_asked(spark):
    fact = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    dim = spark.createDataFrame([(None, "none"), (5, "five")], "k int, name string")
    assert rows(lookup_join(fact, dim, {"k": "k"}, {"name": "n"})) == [(1, None, None), (2, 5, "five")]
    assert rows(lookup_join(fact, dim, {"k": "k"}, {"name": "n"}, null_safe=True)) == [(1, None, "none"), (2, 5, "five")]


def test_rows_without_a_key_are_dealt_over_all_tasks(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = spark.range(8000).selectExpr("id", "CASE WHEN id % 4 > 0 THEN id END AS a", "'x' AS b")
        joined = lookup_join(fact, spark.range(6000).selectExpr("id AS key", "'x' AS k", "id AS v"), {"a": "key", "b": "k"}, {"v": "v"})
        counts = [r["count"] for r in joined.where("a IS NULL").groupBy(F.spark_partition_id().alias("task")).count().collect()]
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sum(counts) == 2000 and len(counts) == width > 1 and max(counts) < 2 * 2000 / width
        assert joined.columns == ["id", "a", "b", "v"] and joined.where("v = a").count() == 4500
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_composite_key(spark):
    fact = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, None, 1)], "id int, x string, y int")
    dim = spark.createDataFrame([("a", 1, "yes"), (None, 1, "no")], "p string, q int, v string")
    assert rows(lookup_join(fact, dim, {"x": "p", "y": "q"}, {"v": "v"}), "id", "v") == [(1, "yes"), (2, None), (3, None)]


def test_output_names_must_be_new(spark):
    with pytest.raises(ValueError, match="already exist"):
        lookup_join(facts(spark), dims(spark), {"k": "key"}, {"name": "id"})


def test_map_columns_at_any_size(spark, no_broadcast):
    fact = facts(spark, 60).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    assert lookup_join(fact, dims(spark), {"k": "key"}, COLUMNS).count() == 60
    assert flag_unique(fact, ["k"], "alone").where("m['a'] = id").count() == 60


def test_flag_unique_is_exact(spark):
    df = facts(spark).withColumn("k", F.expr("CASE WHEN id < 100 THEN -id ELSE k END"))
    flagged = flag_unique(df, ["k"], "alone")
    counts = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert sorted(counts.values())[0] == 1
    assert rows(flagged, "id", "alone") == sorted(((r.id, counts[r.k] == 1) for r in df.collect()), key=repr)


def test_two_open_rows_of_a_key_do_not_double_a_claim(spark):
    claims = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, ref string")
    dim = spark.createDataFrame([("a", "x", True), ("a", "y", True), ("a", "z", False)], "key string, v string, is_active boolean")
    star = build_star(claims, [DimRef("d", dim, "ref", "key", {"v": "v"})])
    assert rows(star) == [(1, "a", "x", False), (2, "b", None, True), (3, None, None, False)]


def test_claims_are_scanned_once(spark, no_broadcast):
    plan = warehouse.claim_fact(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sf0.001/lineitem.parquet") == 1
    assert len(ENTITIES) >= 4 and plan.count("SortMergeJoin") == 4

from __future__ import annotations

import hashlib
import zlib
from math import isqrt

import duckdb
import pytest
from pyspark.sql import functions as F

from dimflow.llm import queries, sharding


def plain_place(number, n, seed):
    """The permutation by definition: rounds on the halves, again while outside."""
    side, value = isqrt(n - 1) + 1, number
    while True:
        left, right = divmod(value, side)
        for i in range(sharding.ROUNDS):
            noise = int(hashlib.md5(f"{seed}:{i}:{right}".encode()).hexdigest()[:13], 16)
            left, right = right, (left + noise) % side
        value = left * side + right
        if value < n:
            return value


@pytest.mark.parametrize("n", [1, 3, 7, 50, 2501])
def test_permutation_is_the_plain_one_and_turns_back(spark, n):
    permutation = sharding.Permutation(spark, n, "seed")
    numbers = spark.range(n).select("id", permutation.forward(F.col("id")).alias("place"))
    found = numbers.select("id", "place", permutation.backward(F.col("place")).alias("again")).collect()
    assert sorted(r.place for r in found) == list(range(n))
    assert all(r.again == r.id and r.place == plain_place(r.id, n, "seed") for r in found)


def test_long_walks_end(spark):
    """Small squares have walks of many steps; every one ends inside."""
    for n in (2, 6, 10, 11, 18, 26, 37):
        permutation = sharding.Permutation(spark, n, f"s{n % 3}")
        places = spark.range(n).select(permutation.forward(F.col("id")).alias("p")).collect()
        assert sorted(r.p for r in places) == list(range(n))


def test_shards_of_awkward_rows(spark, docs, texts):
    found, permutation = sharding.shard(docs.withColumn("slot", F.lit("clash")).withColumn("__part_of", F.lit(1)), 7)
    rows = found.collect()
    assert [r.row_number for r in sorted(rows, key=lambda r: r.doc_id)] == list(range(len(texts)))
    assert {r.doc_id: r.text for r in rows} == dict(enumerate(texts))
    assert all((r.shard, r.slot) == (p % 7, p // 7) for r in rows for p in [plain_place(r.row_number, len(texts), "shard")])
    sizes = [sorted(r.slot for r in rows if r.shard == s) for s in range(7)]
    assert all(x == list(range(len(x))) for x in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    held = found.select("row_number", permutation.row_at(F.col("shard"), F.col("slot"), 7).alias("held"))
    assert held.filter("held <> row_number").isEmpty()


def test_order_of_the_input_does_not_matter(spark, docs):
    once = sharding.shard(docs, 5)[0].select("doc_id", "shard", "slot")
    again = sharding.shard(docs.orderBy(F.desc("text")).repartition(7), 5)[0].select("doc_id", "shard", "slot")
    assert sorted(once.collect()) == sorted(again.collect())


def test_one_key_on_most_rows_is_split(spark, docs):
    copies = docs.filter("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")).crossJoin(spark.range(500)).drop("id")
    found, _ = sharding.shard(copies.unionByName(docs), 4)
    rows = found.collect()
    assert len({r.row_number for r in rows}) == len(rows) == 500 + docs.count()
    assert sorted(r.row_number for r in rows if r.doc_id is None) == list(range(500))


def test_no_rows(spark, no_docs):
    assert sharding.shard(no_docs, 3)[0].collect() == []


def test_written_shards_read_back_in_order(spark, docs, tmp_path):
    found, _ = sharding.shard(docs, 3)
    sharding.write(found, str(tmp_path / "out"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.shard, r.slot, r.doc_id) for r in back) == sorted((r.shard, r.slot, r.doc_id) for r in found.collect())
    assert len(list((tmp_path / "out" / "shard=0").glob("*.parquet"))) > 1


def test_query_equals_its_sql(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_shards(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = connection.execute(queries.SQL["op11_shards"])
    names = [c[0] for c in expected.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(expected.fetchall())
    by_id = {r.doc_id: r for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32((by_id[r.doc_id].text or "").encode()) for r in found.collect())

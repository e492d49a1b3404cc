from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from dimflow.llm import mixing
from dimflow.llm.queries import QUERIES, SQL


def fill(sizes, weights, share, cap):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_and_taken_words(docs):
    mixed = mixing.mix(docs.withColumn("target", F.lit("clash")).withColumn("u", F.lit(0))).collect()
    assert len(mixed) == docs.count()
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in mixed:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    expected = fill(sizes, (3, 1, 2), 1.5, 2.0)
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
    assert all(abs(taken[s] - expected[s]) <= longest[s] / 2 + 1 for s in sizes)
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix(docs.withColumn("target", F.lit("clash")).withColumn("u", F.lit(0))).collect()))


def test_many_bands_take_the_same_documents(docs, monkeypatch):
    before = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "BAND_DOCS", 2)
    assert {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()} == before


def test_rows_that_repeat_one_key_are_split(spark):
    rows = [(1, "a b c d", "x")] * 40 + [(2, "a b", "y")] * 3 + [(None, None, None)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in ("x", "y"):
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 2


def test_repeat_and_empty(spark, docs, no_docs):
    mixed = mixing.mix(docs, prefix="__")
    assert mixing.repeat(mixed).count() == mixed.agg(F.sum("__copies")).first()[0]
    assert mixing.mix(no_docs).count() == 0


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = QUERIES["op6_mix_sources"](spark, sf_dir)
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        result = duck.execute(SQL["op6_mix_sources"])
        names = [c[0] for c in result.description]
        expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r)) for r in found.select(*names).collect()) == expected

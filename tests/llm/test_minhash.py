from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts):
    sets = [shingles(x) for x in texts]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_components_equal_brute_force(docs, texts):
    found = minhash.near_duplicates(docs.withColumn("class", F.lit("clash")).withColumn("id", F.lit(1)))
    assert result(found) == brute(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_a_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(f"v{i}" if k == (7 * i) % 60 else w for k, w in enumerate(base)) for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(minhash.near_duplicates(df)) == brute(texts)


@pytest.mark.parametrize("hubs, tile", [(0, 2), (1, 7), (2, 1024)])
def test_tiles_find_what_hubs_leave(spark, docs, texts, monkeypatch, hubs, tile):
    """Near copies that are no copies of each other, and pairs that only their tile can find."""
    monkeypatch.setattr(minhash, "HUBS", hubs)
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(hubs)
    base = [f"w{i}" for i in range(70)]
    ball = [" ".join(f"v{i}.{k}" if k in changed else w for k, w in enumerate(base)) for i in range(60) for changed in [rng.sample(range(70), rng.choice([1, 2, 3]))]]
    pairs = [x.replace("w69", f"u{i // 2}").replace("w35", f"t{i // 2}").replace("w10", f"s{i // 2}") for i, x in enumerate(ball[:20])]
    both = [*texts, *ball, *pairs]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate([*ball, *pairs], len(texts))), "doc_id long, text string"))
    assert result(minhash.near_duplicates(df)) == brute(both)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {r["id"]: r["component"] for r in minhash.components(links).collect()}
    assert found == {i: 1 for i in range(2, 61)} | {101: 100}


def test_repeated_and_missing_keys(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (3, text), (None, text), (None, None), (5, "another text that is nothing like it at all")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (0, 0, True), (3, 3, True), (5, 3, False), (5, 3, False), (5, 3, False),
    ]


def test_no_rows(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_every_coordinate_fills_and_agrees_with_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.unique(np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)]))
    one = np.array([5], np.uint64)
    sketches = minhash.sketch([a, b, one, one, np.zeros(0, np.uint64)])
    assert (sketches[:3] < np.iinfo(np.uint64).max).all()
    assert (sketches[2] == sketches[3]).all()
    assert (sketches[4] == np.iinfo(np.uint64).max).all()
    assert abs((sketches[0] == sketches[1]).mean() - 300 / 500) < 0.1

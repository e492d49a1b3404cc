from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import pitman_yor as py


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.fixture(scope="module")
def corpus(spark):
    """Words that depend on the word before."""
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    follow = {w: rng.sample(words, 4) for w in words}
    rows = []
    for i in range(400):
        text = [rng.choice(words)]
        for _ in range(rng.randint(3, 60)):
            text.append(rng.choice(follow[text[-1]]) if rng.random() < 0.8 else rng.choice(words))
        rows.append((i, " ".join(text)))
    rows += [(1000, None), (1001, ""), (None, "only here unseen words"), (1002, "BAL bal " * 3000), (1002, "again")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))


def test_counts_and_base_score(corpus):
    rows, df = corpus
    counts = Counter(t for i, x in rows if not held_out(i) for t in tokens(x))
    total, known = sum(counts.values()), len(counts)
    found = py.score(df).collect()
    expected = []
    for i, x in rows:
        own = tokens(x)
        base = sum(math.log10((counts[t] + 1) / (total + known + 1)) for t in own)
        expected.append((str(i), held_out(i), len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(expected)


def test_contexts_help_on_held_out_text(corpus):
    found = [r for r in py.score(corpus[1]).collect() if r["held_out"] and (r["doc_id"] or 0) < 1000]
    size = sum(r["n_tokens"] for r in found)
    assert sum(r["score"] for r in found) / size > sum(r["base_score"] for r in found) / size + 0.15


def test_blocks_and_buckets_do_not_change_counts(spark, corpus, monkeypatch):
    before = sorted(str(tuple(r)[:5]) for r in py.score(corpus[1]).collect())
    monkeypatch.setattr(py, "BLOCK", 50)
    assert sorted(str(tuple(r)[:5]) for r in py.score(corpus[1].repartition(3)).collect()) == before


def test_no_rows(no_docs):
    assert py.score(no_docs).count() == 0


def test_awkward_texts(docs, texts):
    found = {r["doc_id"]: r for r in py.score(docs).collect()}
    assert len(found) == len(texts)
    assert all(found[i]["n_tokens"] == len(tokens(x)) and found[i]["score"] < 0 for i, x in enumerate(texts))


def test_predictions_of_a_context_sum_to_one():
    counts = np.array([5, 1, 2, 0, 0], np.int64)
    bucket = py.Bucket(0, np.arange(5, dtype=np.uint64), np.arange(5), np.zeros(5, np.int64), counts)
    bucket.begin()
    state = py.State(8, 3, np.array([8.0]), 0.6, 0.4, np.array([3.0]), 3.0, 3.0)
    chance = bucket.predictive(state)
    # The last two words are unknown; together they stand for the one unknown word of the base.
    assert chance[3] == chance[4]
    assert chance[:3].sum() + chance[3] == pytest.approx(1.0)


def test_tables_follow_the_restaurant_process():
    rng = np.random.default_rng(0)
    size, mass, discount = 60, 1.5, 0.5
    slow = []
    for _ in range(4000):
        t = 1
        for n in range(1, size):
            t += rng.random() < mass / (mass + n - discount * t)
        slow.append(t)
    fast = py.seat(np.full(4000, size), np.full(4000, mass), discount, rng)
    assert fast.mean() == pytest.approx(np.mean(slow), rel=0.05)
    assert py.seat(np.array([0, 1]), np.array([1.0, 1.0]), 0.5, rng).tolist() == [0, 1]


def test_packing():
    arrays = [np.arange(5, dtype=np.uint32), np.zeros(0, np.uint8), np.array([1.5, -2.0])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, py._unpack(py._pack(*arrays)), strict=True))


def test_restaurants_are_of_whole_words(spark):
    """Two words before that end alike are followed by different words."""
    ids = iter(range(10**6))
    learned = [i for i in ids if i < 400 and not held_out(i)][:80]
    probes = [i for i in range(1000, 2000) if held_out(i)][:2]
    rows = [(i, "one-ending yes " * 20 if n % 2 else "two-ending no " * 20) for n, i in enumerate(learned)]
    rows += [(probes[0], "one-ending yes " * 10), (probes[1], "one-ending no " * 10)]
    found = {r["doc_id"]: r["score"] for r in py.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[probes[0]] > found[probes[1]] + 10


@pytest.mark.parametrize("dishes", [4000, py.FEW - 1])
def test_sweeps_remove_and_seat_every_customer(dishes):
    """Numbers of tables after sweeps follow their exact distribution, whatever the seats were at first."""
    size, mass, discount = 7, 1.5, 0.4
    ways = {(0, 0): 1.0}  # of seating n customers at t tables
    for n in range(size):
        for t in range(n + 2):
            ways[n + 1, t] = ways.get((n, t - 1), 0.0) + (n - discount * t) * ways.get((n, t), 0.0)
    weights = [ways[size, t] * mass**t for t in range(size + 1)]
    exact = sum(t * w for t, w in enumerate(weights)) / sum(weights)
    rng = np.random.default_rng(3)
    counts = np.full(dishes, size)
    seats, menu, tables = py.Seats(np.ones(dishes, np.int64), counts), py.Fixed(np.full(dishes, mass)), []
    for sweep in range(12 if dishes > 100 else 800):
        seats = py.reseat(seats, counts, menu, discount, rng)
        assert seats.sizes.min() > 0 and (np.add.reduceat(seats.sizes, np.cumsum(seats.tables) - seats.tables) == size).all()
        tables += [seats.tables.mean()] if sweep > 5 else []
    assert np.mean(tables) == pytest.approx(exact, rel=0.02)


def test_customers_that_come_and_leave():
    rng = np.random.default_rng(4)
    seats = py.Seats(np.array([2, 0, 1, 1]), np.array([3, 1, 1, 5]))
    counts = np.array([2, 3, 0, 9])
    after = py.reseat(seats, counts, py.Fixed(np.full(4, 0.7)), 0.3, rng)
    ends = np.cumsum(after.tables)
    assert [int(after.sizes[b - t : b].sum()) for t, b in zip(after.tables, ends, strict=True)] == counts.tolist()

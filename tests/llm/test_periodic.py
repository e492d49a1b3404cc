from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dimflow.llm import queries
from dimflow.llm.periodic import Factors, collapse, periodic, strongest


def plain_runs(words):
    """Runs by definition: every stretch whose words q apart are equal, for every q."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            stretch = words[start : start + length]
            smallest = next(p for p in range(1, q + 1) if all(stretch[i] == stretch[i + p] for i in range(length - p)))
            if length >= max(6, 4 * q) and smallest == q:
                found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def periodic_texts():
    rng = random.Random(11)
    made = []
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 4)):
            root = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
            words += (root * 7)[: rng.randint(1, 40)] + [rng.choice("abxyz") for _ in range(rng.randint(0, 6))]
        made.append(words)
    made += [[rng.choice("ab") for _ in range(rng.randint(0, 60))] for _ in range(250)]
    made += [list("abab" * 3 + "c" + "abab" * 3), ["w"] * 500, [], ["a"], ["a"] * 5, ["a"] * 6, (list("ab") * 5 + ["c"]) * 5]
    long = [str(rng.randint(0, 9)) for _ in range(80)]
    made += [long, (long * 5)[:350], long * 4]
    return made


def test_runs_equal_brute_force():
    texts = [[w.encode() for w in words] for words in periodic_texts()]
    expected = [plain_runs(words) for words in texts]
    assert Factors(texts).search() == expected
    assert sum(map(len, expected)) > 100
    for words, runs in zip(texts, expected, strict=True):
        assert Factors([words]).search() == [runs]
        assert collapse(words, runs) == plain_collapse(words, runs)


def test_awkward_texts_through_spark(spark, docs, no_docs, texts):
    found = docs.withColumn("runs", F.lit("clash")).select("doc_id", "runs", periodic("text").alias("found")).collect()
    by_id = {r.doc_id: r.found for r in found}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words) if len(words) < 2000 else [(0, 6000, 1)]
        assert [tuple(r) for r in by_id[i].runs] == runs
        assert by_id[i].collapsed == " ".join(plain_collapse(words, runs))
    assert no_docs.select(periodic("text")).collect() == []


def test_strongest_run_is_compared_exactly(spark):
    def best(*runs):
        rows = spark.createDataFrame([(list(runs),)], "runs array<struct<start: long, length: long, period: long>>")
        found = rows.select(strongest(F.col("runs")).alias("best")).first().best
        return found and tuple(found)

    assert best() is None
    assert best((0, 8, 2), (3, 9, 2), (5, 18, 4)) == (3, 9, 2)
    assert best((1, 12, 3), (2, 8, 2), (2, 12, 3)) == (1, 12, 3)
    assert best((0, 3 * 10**9, 10**9 - 1), (1, 3 * 10**9 + 2, 10**9 - 1)) == (1, 3 * 10**9 + 2, 10**9 - 1)


@pytest.mark.parametrize("sizes", [(1, 1), (60, 3)])
def test_query_equals_brute_force(spark, docs, texts, tmp_path, sizes):
    """Many ids, so that a tenth of the texts goes round from some word on."""
    copies, step = sizes
    more = [((i * step + k) * 3, t, "en", "s", 0) for k in range(copies) for i, t in enumerate(texts[:50:step] if copies > 1 else texts) if len(t or "") < 3000]
    spark.createDataFrame(more, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert len(rows) == len(more)
    expected = set()
    for doc_id, text, *_ in more:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, " ".join(plain_collapse(words, runs)))]
        expected.add((doc_id, len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2], *digests))
    assert {tuple(r) for r in rows} == expected
    assert copies == 1 or sum(r.n_runs for r in rows) > 50

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from dimflow.llm import importance, queries


def plain_buckets(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10_000 for r in runs)


def plain_resample(rows, target, least=20, share=(5, 100)):
    """By definition; rows are (doc_id, text), the result is keyed by the row's position."""
    parts = [plain_buckets(text) for _, text in rows]
    s, t = (sum((c for _, c in x), Counter()) for x in (parts, [plain_buckets(x) for x in target]))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    found = []
    for (doc_id, _), (n, counts) in zip(rows, parts, strict=True):
        weight = sum(k * gain(b) for b, k in counts.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc_id, counts.total(), weight, score, None, n >= least])
    takes = sorted((r for r in found if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(takes[: share[0] * len(takes) // share[1]]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in found)


LINES = [
    "One line of some words here that is on every page",
    "another line",
    "x",
    "",
    "Ünïcode wörds, 漢字 and 123 numbers; A-Z!",
    "it's\ttabs\x0band\x00nul\rreturns",
]
TEXTS = ["\n".join(LINES[(i * k + k) % 6] for k in range(i % 9)) + " tail" * (i % 4) for i in range(90)]


def found_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_equals_brute_force(spark, docs, texts):
    rows = [(None if i % 40 == 7 else i, t) for i, t in enumerate(TEXTS + texts + texts[:3])]
    target = ["One line of other words\nhere", None, "", *texts[3:6]]
    frame = spark.createDataFrame([(i, t, "clash", {"a": 1}) for i, t in rows], "doc_id long, text string, rank string, line map<string, int>")
    wanted = spark.createDataFrame([(t, "x") for t in target], "text string, n string")
    result = importance.resample(frame, wanted, share=(50, 100))
    assert found_of(result) == plain_resample(rows, target, share=(50, 100))
    assert "line" in result.columns and "text" not in result.columns
    assert sorted(r.rank for r in result.filter("rank is not null").collect()) == list(range(1, 1 + result.filter("rank is not null").count()))


def test_cold_lines_meet_in_a_join(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(importance, "HOT", 0)
    rows = list(enumerate(texts))
    assert found_of(importance.resample(docs, docs.limit(5))) == plain_resample(rows, [r.text for r in docs.limit(5).collect()])


def test_line_ends_never_split_a_feature():
    for text in TEXTS + ["a\nb\nc\nd e\n\nf", "a b c\nd", "a\n\n\nb c", "\n", "a"]:
        n, lines, crossing = importance.text_parts(text.encode())
        packed = b"".join(importance.line_buckets(line) * k for line, k in lines.items()) + crossing
        found = Counter(int.from_bytes(packed[i : i + 2], "little") for i in range(0, len(packed), 2))
        assert (n, found) == plain_buckets(text)


def test_no_rows_and_no_target(spark, docs, no_docs, texts):
    assert importance.resample(no_docs, docs).collect() == []
    assert found_of(importance.resample(docs, no_docs)) == plain_resample(list(enumerate(texts)), [])


def test_query_equals_its_sql(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.filter("doc_id < 6").select(F.col("doc_id").alias("item_id"), "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = queries.op13_importance(spark, str(tmp_path))
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    expected = connection.execute(queries.SQL["op13_importance"])
    names = [c[0] for c in expected.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(expected.fetchall())

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dimflow.llm import pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def right(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9) for i, d in enumerate(map(int, reversed(digits))))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(kind, *m.span()) for kind, p in PATTERNS.items() for m in p.finditer(text) if right(kind, m.group())]


def test_direct_identifiers_equal_the_patterns():
    rng = random.Random(1)
    for k in range(20_000):
        text = "".join(rng.choice("0123456789.@a-+ (é%" if k % 3 else "0 19-+5.") for _ in range(rng.randint(0, 45)))
        assert pii.find(text) == brute(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "@a" * 50_000, "+1" + "(" * 100_000, "1." * 100_000])
def test_long_runs_take_linear_time(text):
    pii.find(text)


def test_a_term_that_gives_an_entity_away(spark):
    fill = [f"filler{i} plain{i} other{i} more{i} text{i}" for i in range(80)]
    rows = [(i, f"{fill[i]} Zorbax{' of' * (i % 3)} the ann@ex.org {fill[i + 20]} 10.0.0.{i}") for i in range(12)]
    rows += [(100 + i, f"{fill[i]} the words of {fill[40 + i]}") for i in range(40)]
    df = spark.createDataFrame([*rows, (500, None), (501, ""), (0, rows[0][1])], "doc_id long, text string").withColumn("terms", F.lit(1))
    found = {r["doc_id"]: r for r in pii.detect(df).collect()}
    assert len(found) == len(rows) + 2
    for i, text in rows[:12]:
        words = {text[s["start"] : s["end"]] for s in found[i]["spans"] if s["kind"] == pii.TERM}
        assert words == {"Zorbax"}
        assert [(s["kind"], s["start"], s["end"]) for s in found[i]["spans"] if s["kind"] != pii.TERM] == brute(text)
    assert not found[100]["spans"] and not found[500]["spans"] and not found[501]["spans"]
    clean = {r["doc_id"]: r["text"] for r in pii.redact(pii.detect(df)).collect()}
    assert "Zorbax" not in clean[3] and "ann@" not in clean[3] and "[EMAIL]" in clean[3] and "[IP]" in clean[3]
    assert clean[100] == dict(rows)[100] and clean[500] is None


def test_awkward_texts(docs, no_docs, texts):
    assert pii.detect(docs).count() == len(texts)
    assert pii.detect(no_docs).count() == 0


def test_overlaps_and_classes(spark):
    df = spark.createDataFrame([(1, "call +1 234 567 8901 or 4111 1111 1111 1111 now")], "doc_id long, text string")
    assert pii.redact(pii.detect(df)).first()["text"] == "call [PHONE] or [CARD] now"
    assert [pii._term_class(w) for w in ("12", "Ann", "ann")] == ["[NUMBER]", "[NAME]", "[WORD]"]


def test_disclosing_terms_are_marked_at_every_place(spark):
    fill = [" ".join(f"{w}{i}" for w in ("filler", "plain", "other", "more", "text", "far")) for i in range(160)]
    rows = [(i, f"Zorbax {fill[i]} Zorbax and ann@ex.org {fill[i + 20]} {fill[i + 40]} Quimby") for i in range(12)]
    rows += [(100, f"{fill[90]} zorbax {fill[91]}, Quimby")]
    rows += [(200 + i, f"{fill[i]} and the words of {fill[60 + i]}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.detect(df).collect()}
    for i, text in rows:
        marked = [(s["start"], s["end"]) for s in found[i] if s["kind"] == pii.TERM]
        assert marked == [m.span() for m in re.finditer("[Zz]orbax|Quimby", text)]
    clean = {r["doc_id"]: r["text"].lower() for r in pii.redact(pii.detect(df)).collect()}
    assert not any("zorbax" in x or "quimby" in x for x in clean.values())

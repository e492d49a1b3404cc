from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from dimflow.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = "aé \n\t\xa0'sßtheIN漢  .,!12  "


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.Ranks.parse(file.read())


@pytest.fixture(scope="module")
def expected(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={}).encode_ordinary


def test_encoder_equals_the_library(ranks, expected, texts):
    encoder, rng = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(3)
    samples = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for text in [*(x for x in texts if x is not None), *samples, "<|endoftext|>"]:
        assert encoder.encode(text) == expected(text)


def test_memory_of_the_encoder_is_bounded_and_changes_nothing(ranks, expected, texts, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 5)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in texts:
        assert encoder.encode(text or "") == expected(text or "")
    assert len(encoder.young) <= 6


def test_appends_and_edits_equal_encoding_again(ranks, expected):
    rng = random.Random(4)
    for _ in range(300):
        text, new = ("".join(rng.choice(SIGNS) for _ in range(rng.randint(0, n))) for n in (40, 6))
        start = rng.randint(0, len(text))
        stop = rng.randint(start, len(text))
        edited = bpe.EditableText(ranks, public_tokenizers.PATTERN, text)
        edited.replace(start, stop, new)
        assert edited.tokens() == expected(text[:start] + new + text[stop:])
        edited.append(new)
        assert edited.tokens() == expected(text[:start] + new + text[stop:] + new)


def test_piece_table_appends(ranks, expected):
    table = bpe.PieceTable(ranks, b"thin")
    table.append(b"king")
    assert table.tokens() == expected("thinking")
    table.replace(0, 5, b"wor")
    assert table.tokens() == expected("woring")


def test_columns_round_trip(spark, docs, expected):
    coded = bpe.decode(bpe.encode(docs.withColumn("ids", F.lit("clash")), PATH, public_tokenizers.PATTERN), PATH)
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    for row in coded.select("*", bpe.pack_ids(F.col("ids")).alias("packed")).collect():
        assert row["ids"] == expected(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
        assert np.frombuffer(row["packed"], "<u4").tolist() == row["ids"]


def test_empty_table(no_docs):
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_vocabulary_without_bytes_is_refused():
    with pytest.raises(ValueError):
        bpe.Ranks({b"a": 0})


def test_tables_from_either_end_agree(ranks):
    rng = random.Random(8)
    for _ in range(400):
        data = "".join(rng.choice("thienaosé漢 ") for _ in range(rng.randint(1, 30))).encode()
        last: list = [-1]
        ranks.extend(data, last, 0)
        lazy = [None] * (len(data) + 1)
        ranks.last_token(data, len(data), lazy)
        assert all(found in (None, token) for found, token in zip(lazy[1:], last[1:], strict=True))
        assert ranks.tokens(data) == ranks.walk(last)


def test_query_equals_the_library(spark, docs, expected, texts, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op1_byte_bpe(spark, str(tmp_path)).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id] or ""
        ids = np.array(expected(text), "<u4")
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

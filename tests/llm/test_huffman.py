from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dimflow.llm import huffman, queries
from dimflow.storage import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library, texts):
    with open(PATH, "rb") as file:
        encoder = huffman.WordEncoder(file.read())
    rng = random.Random(6)
    samples = ["".join(rng.choice("aé\x1c \n\t\xa0'sßtheIN漢́  .,!12 ΣKİ") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    samples += ["".join(rng.choice(["<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", " ", "a", "É", "."]) for _ in range(9)) for _ in range(300)]
    for batch in ([x or "" for x in texts], samples, ["hello <|endoftext|> world", "<|startoftext|>it's<|endoftext|><|ENDOFTEXT|>"], []):
        found = encoder.packed(pa.array(batch, pa.string()))
        assert [np.frombuffer(x, "<u2").tolist() for x in found] == [library(text) for text in batch]


def test_memory_of_the_encoder_is_bounded_and_changes_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(huffman, "MEMORY", 5)
    with open(PATH, "rb") as file:
        encoder = huffman.WordEncoder(file.read())
    for text in texts:
        (found,) = encoder.packed(pa.array([text or ""]))
        assert np.frombuffer(found, "<u2").tolist() == library(text)
    assert len(encoder.young) < 400


def test_other_tokenizers_encode_words_themselves(texts):
    form = json.loads(open(PATH).read())
    form["normalizer"]["normalizers"].pop()
    encoder, plain = huffman.WordEncoder(json.dumps(form).encode()), Tokenizer.from_str(json.dumps(form))
    assert not encoder.own_pieces
    found = encoder.packed(pa.array([x or "" for x in texts]))
    assert [np.frombuffer(x, "<u2").tolist() for x in found] == [plain.encode(x or "", add_special_tokens=False).ids for x in texts]
    form["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError, match="added"):
        huffman.WordEncoder(json.dumps(form).encode())


def test_query_equals_the_library(spark, docs, library, texts, tmp_path):
    more = spark.createDataFrame([(1000, "a <|endoftext|> b", "en", "s", 0)], docs.schema)
    docs.unionByName(more).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op8_huffman_ids(spark, str(tmp_path)).collect()}
    expected, start = {}, 0
    for doc_id, text in [*enumerate(texts), (1000, "a <|endoftext|> b")]:
        ids = [*library(text), 2]
        expected[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert found == expected


@pytest.mark.parametrize("longest", [9, 12, 18])
def test_lengths_are_limited_and_complete(longest):
    counts = np.array([0, *(2**i for i in range(20)), *([3] * 300)])
    lengths = huffman.code_lengths(counts, longest)
    assert lengths[0] == 0 and lengths.max() <= longest
    assert sum(2.0 ** -int(n) for n in lengths if n) == 1.0


def test_lengths_are_optimal_without_a_tight_limit():
    import heapq

    counts = np.random.default_rng(0).integers(1, 1000, 200)
    heap = list(map(int, counts))
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        total += (pair := heapq.heappop(heap) + heapq.heappop(heap))
        heapq.heappush(heap, pair)
    assert int((huffman.code_lengths(counts) * counts).sum()) == total


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_code_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 40_000).astype(np.uint32)
    code = huffman.Code(huffman.code_lengths(np.bincount(ids, minlength=2)))
    payload, checkpoints = code.encode(ids)
    assert (code.decode(payload, n, checkpoints) == ids).all()


def test_one_id_and_too_many_ids():
    code = huffman.Code(huffman.code_lengths(np.bincount([5])))
    assert code.decode(*_coded(code, [5, 5, 5])).tolist() == [5, 5, 5]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, int), 2)


def _coded(code, ids):
    payload, checkpoints = code.encode(np.array(ids))
    return payload, len(ids), checkpoints


def test_files(spark, docs, library, texts, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 100)
    monkeypatch.setattr(huffman, "PART_IDS", 3000)
    tokens = huffman.tokenize(docs, PATH, end_id=2)
    path = scratch_dir(spark, "test-huffman")
    huffman.write(tokens, path, width=2)
    rows = {r["doc_id"]: r for r in huffman.read(spark, path).collect()}
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 1
    before = 0
    for i, text in enumerate(texts):
        ids = [*library(text), 2]
        assert np.frombuffer(rows[i]["ids"], "<u4").tolist() == ids
        assert (rows[i]["start"], rows[i]["n_tokens"]) == (before, len(ids))
        assert zlib.crc32(rows[i]["ids"]) == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)


def test_no_rows_and_missing_or_repeated_keys(spark, no_docs):
    path = scratch_dir(spark, "test-huffman")
    huffman.write(huffman.tokenize(no_docs, PATH, end_id=2), path, width=2)
    assert huffman.read(spark, path).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (4, "c"), (4, "c"), (4, None)], "doc_id long, text string")
    path = scratch_dir(spark, "test-huffman")
    huffman.write(huffman.tokenize(rows, PATH, end_id=2), path, width=2)
    found = huffman.read(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, 4, 4, 4]
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from dimflow.llm import common, toxicity


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def corpus(spark):
    """Toxic documents have a known insult or a word of an unknown stem, anywhere among common words."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghilmnost") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = int(i % 5 == 0)
        if toxic:
            insult = rng.choice(["moron", "scum", "zorgl" + rng.choice(["a", "ek", "ist", "ung"])])
            text.insert(rng.randint(0, len(text)), insult)
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    rows += [(2000, None), (2001, ""), (2002, rows[0][1]), (2003, "word " * 20_000 + "moron")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    return docs, known, dict(labels)


def test_held_out_documents(corpus):
    docs, known, labels = corpus
    model = toxicity.fit(docs, known)
    assert "zorgl*" in {entry[:5] + "*" for entry in model.lexicon}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    unseen = [i for i in labels if held_out(i)]
    assert np.mean([(scores[i] >= 0.7) == labels[i] for i in unseen]) >= 0.98
    assert scores[2000] == scores[2001] < 0.5 < scores[2003]
    again = toxicity.fit(docs, known)
    assert again.lexicon == model.lexicon and np.allclose(again.weights, model.weights)


def test_held_out_labels_are_not_learned_from(corpus, spark):
    docs, known, labels = corpus
    flipped = spark.createDataFrame([(i, 1 - y if held_out(i) else y) for i, y in labels.items()], "doc_id long, toxic int")
    one, other = toxicity.fit(docs, known), toxicity.fit(docs, flipped)
    assert one.lexicon == other.lexicon and np.allclose(one.weights, other.weights)


def test_without_labels_known_insults_decide(spark, no_docs):
    docs = spark.createDataFrame([(1, "you moron"), (2, "good day"), (3, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert scores[1] >= 0.7 > scores[2] == scores[3]
    assert toxicity.score(no_docs, model).count() == 0


def test_votes_respect_word_ends():
    voters = toxicity.Voters(["idiot", "zorg*"])
    assert voters.votes("An IDIOT, zorgling") == [0, 1]
    assert voters.votes("idiots azorg idioti") == []


def test_voters_that_agree_vote_as_one():
    counts = np.array([[10, 9, 1], [9, 10, 1], [1, 1, 8]])
    assert toxicity._groups(counts) == [[0, 1], [2]]


def test_label_model_weighs_voters_by_how_they_agree():
    rng = np.random.default_rng(3)
    truth = rng.random(2000) < 0.2
    good = truth & (rng.random(2000) < 0.8)
    noise = rng.random(2000) < 0.3
    given = np.where(rng.random(2000) < 0.05, ~truth, truth)
    posterior, _, on_toxic, on_other = toxicity._label_model(np.column_stack([good, noise]), given.astype(int))
    assert on_toxic[0] / on_other[0] > 20 and on_toxic[1] / on_other[1] < 2
    assert ((posterior > 0.5) == truth).mean() > ((given == truth).mean())


def test_a_cut_sample_keeps_the_true_share_of_toxic_rows(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghilmnost") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    rows = []
    for i in range(6000):
        toxic = int(i % 12 == 0)
        text = rng.choices(words, k=12) + (["zorgl"] if toxic and rng.random() < 0.7 else [])
        if rng.random() < (0.3 if toxic else 0.1):  # three times more frequent in toxic rows
            text.append("trash")
        rows.append((i, " ".join(text), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    probe = spark.createDataFrame([(1, "some trash here"), (2, "such a zorgl")], "doc_id long, text string")

    def fitted():
        model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
        return model.prior, [r["score"] for r in toxicity.score(probe, model).orderBy("doc_id").collect()]

    prior, whole = fitted()
    monkeypatch.setattr(toxicity, "SAMPLE", 600)  # 300 of each class
    cut_prior, cut = fitted()
    assert cut_prior == pytest.approx(prior, abs=1e-9) and prior < 0.1
    assert cut[0] == pytest.approx(whole[0], abs=0.15) and cut[0] < 0.5 and cut[1] >= 0.7


def test_a_worker_lets_go_of_other_operators_and_hands_counts_on(monkeypatch):
    texts = [f"word{i} common text {'vile' if i % 2 else 'kind'}" for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 2 for i in range(300)], pa.int32()), pa.array(texts)], names=["label", "text"])

    def totals(batches):
        found = {}
        for b in batches:
            for entry, other, toxic in zip(*(c.to_pylist() for c in b.columns), strict=True):
                old = found.get(entry, (0, 0))
                found[entry] = (old[0] + other, old[1] + toxic)
        return found

    sent = cloudpickle.loads(cloudpickle.dumps(common.tidied(toxicity._tally)))  # as Spark sends it to a worker
    common.kept("another operator's", dict)
    whole = [*sent(iter([batch]))]
    assert not common._KEPT and len(whole) == 1
    monkeypatch.setattr(toxicity, "GATHERED", 50)
    parts = [*toxicity._tally(iter([batch]))]
    assert len(parts) > 10 and max(b.num_rows for b in parts) < 70
    assert totals(parts) == totals(whole) and totals(whole)["common"] == (150, 150)

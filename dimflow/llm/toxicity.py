"""Toxicity by weak supervision.

Voters are words and word stems that a lexicon mined from labelled rows holds, a short list of insults known
beforehand, and patterns of form. No voter is trusted: a generative model with one hidden class per document estimates
how often each votes on toxic and on other documents, by expectation maximisation over the voters and the given label,
which is one voter among them. Voters that agree more than the class explains are found from counts over the whole
corpus and vote as one. A linear classifier is then trained on the model's posterior labels and scores every document.

Learning uses a bounded sample of labelled rows, ``SAMPLE`` at most, each weighted by the rows of its class that it stands
for, as counted over all rows; so the share of toxic rows that the model sees is the true one at every size. What is broadcast or reaches the driver is bounded by
``SAMPLE`` and ``VOTERS``. Scores depend on the text only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import give_back, kept, key_crc, stored, tidied, tidy

#: Labelled rows to learn from (half of each class at most), and voters in the lexicon.
SAMPLE, VOTERS = 20_000, 256
#: Documents that must support a lexicon entry, its evidence (twice the log likelihood ratio) against chance, and how many
#: times more frequent it must be in toxic rows.
SUPPORT, EVIDENCE, ODDS = 4, 20.0, 20.0
#: Lengths of word beginnings that count as stems.
STEMS = (4, 5, 6, 7, 8)
#: Entries or places that a worker gathers before it hands them on.
GATHERED = 50_000

# Insults in four languages that vote without any labels.
INSULTS = (
    "idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "imbecile", "trash",
    "dumm", "abschaum", "versager", "wertlos", "widerlich",
    "imbécile", "crétin", "ordure", "minable", "dégoûtant",
    "estúpido", "imbécil", "escoria", "patético", "asqueroso",
)

_WORD = re.compile(r"\w+")
_FORMS = (
    ("capitals", lambda text: sum(map(str.isupper, text)) > 0.5 * max(20, len(text))),
    ("exclaims", lambda text: text.count("!!") > 3),
    ("second person", lambda text: bool(re.search(r"\b(?:you are|you're|du bist|tu es|eres) (?:an? )?\w+!", text, re.I))),
)


def entries(text: str) -> set[str]:
    """The words of a text in lower case and their stems, which end in ``*``."""
    words = {word for word in _WORD.findall(text.lower()) if 3 <= len(word) <= 40}
    return words | {word[:n] + "*" for n in STEMS for word in words if len(word) >= n}


class Voters:
    """Finds the votes of lexicon entries in one pass over a text; forms vote after them."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = lexicon
        self.size = len(lexicon) + len(_FORMS)
        self.found = ahocorasick.Automaton()
        for i, entry in enumerate(lexicon):
            stem = entry.rstrip("*")
            whole, begin = self.found.get(stem, (-1, -1))
            self.found.add_word(stem, (whole, i) if entry != stem else (i, begin))
        if lexicon:
            self.found.make_automaton()

    def votes(self, text: str) -> list[int]:
        low, voted = text.lower(), set()
        if self.lexicon:
            for end, (whole, begin) in self.found.iter(low):
                size = len(self.lexicon[whole if whole >= 0 else begin].rstrip("*"))
                start = end + 1 - size
                if start and _is_word(low[start - 1]):
                    continue
                if begin >= 0:
                    voted.add(begin)
                if whole >= 0 and (end + 1 == len(low) or not _is_word(low[end + 1])):
                    voted.add(whole)
        voted.update(len(self.lexicon) + i for i, (_, test) in enumerate(_FORMS) if test(text))
        return sorted(voted)


def _voters(lexicon: list[str]) -> Voters:
    return kept(("voters", tuple(lexicon)), lambda: Voters(lexicon))


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


@dataclass
class Model:
    """The lexicon, the classifier's weights, and what the label model found about the voters."""

    lexicon: list[str]
    weights: np.ndarray
    bias: float
    prior: float = 0.5
    on_toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    on_other: np.ndarray = field(default_factory=lambda: np.zeros(0))
    groups: list[list[int]] = field(default_factory=list)

    def score(self, voters: Voters, text: str) -> float:
        """Every group that votes counts once, and their number counts as well."""
        member = self.member
        voted = {member[v] for v in voters.votes(text)}
        z = self.bias + self.weights[sorted(voted)].sum() + self.weights[-1] * len(voted)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    @cached_property
    def member(self) -> dict[int, int]:
        return {v: g for g, group in enumerate(self.groups) for v in group}


def training_labels(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """(key, label) of rows to learn from: one per document, toxic if any of its rows says so; held-out ones left out."""
    known = labels.filter((key_crc(key) % 3 != 1) & F.col(label).isNotNull() & F.col(key).isNotNull())
    return known.groupBy(F.col(key).alias("__key")).agg(F.max((F.col(label) > 0).cast("int")).alias("__label"))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of at most ``SAMPLE`` labelled texts, the same in every run, and how many there are of each label.

    Equal texts count once and are toxic if one of them is. The numbers are counted over all rows, so that the sampled
    ones can be weighted back.
    """
    known = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("__key"), F.xxhash64(text).alias("content"))
    usable = known.join(labels, "__key").groupBy("content").agg(F.max("__label").alias("label"))
    usable = stored(usable, "toxicity-labelled")
    totals = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    halves = [usable.filter(F.col("label") == y).orderBy(F.xxhash64("content"), "content").limit(SAMPLE // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # SAMPLE rows of two numbers
    rows = docs.filter(F.col(text).isNotNull()).select(F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    rows = rows.join(chosen, "content").groupBy("content").agg(F.max("label").alias("label"), F.max("text").alias("text"))
    return stored(rows.select("label", "text"), "toxicity-sample"), totals


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, other, toxic) counts of labelled texts, an entry as often as the worker handed its counts on."""

    def handed_on(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)]
        return pa.RecordBatch.from_arrays(columns, names=["entry", "other", "toxic"])

    counts = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[label].update(entries(text.as_py()))
            if len(counts[0]) + len(counts[1]) >= GATHERED:
                yield handed_on(counts)
                counts = (Counter(), Counter())
    yield handed_on(counts)


def _mine(sample: DataFrame) -> list[str]:
    """Entries that toxic rows have significantly more often, in independent places."""
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return []

    counted = sample.select("label", "text").mapInArrow(tidied(_tally), "entry string, other long, toxic long")
    counted = counted.groupBy("entry").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))

    def term(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    share = (F.col("toxic") + F.col("other")) / float(toxic + other)
    evidence = 2 * sum(
        term(n, size * e)
        for n, size, e in (
            (F.col("toxic"), float(toxic), share), (F.col("other"), float(other), share),
            (toxic - F.col("toxic"), float(toxic), 1 - share), (other - F.col("other"), float(other), 1 - share),
        )
    )
    odds = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("other") + 0.5) / (other + 1))
    best = (
        counted.filter(F.col("toxic") >= SUPPORT)
        .withColumns({"evidence": evidence, "odds": odds})
        .filter((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= ODDS))
        .orderBy(F.desc("evidence"), F.desc(F.length("entry")), "entry")
        .limit(8 * VOTERS)
        .collect()
    )
    # Copies of one document support all of its words in the same places; an insult turns up in places of its own.
    names = [row["entry"] for row in best]
    wanted = frozenset(names)

    def handed_on(seen: set) -> pa.RecordBatch:
        rows = list(zip(*seen, strict=True)) if seen else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in rows], names=["entry", "place"])

    @tidied
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for text in batch.column(0):
                words = _WORD.findall(text.as_py().lower())
                for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                    for entry in (word, *(word[:n] + "*" for n in STEMS if len(word) >= n)):
                        if entry in wanted:
                            seen.add((entry, f"{before} {after}"))
                if len(seen) >= GATHERED:
                    yield handed_on(seen)
                    seen = set()
        yield handed_on(seen)

    found = sample.filter("label = 1").select("text").mapInArrow(places, "entry string, place string")
    spread = {row["entry"]: row["n"] for row in found.groupBy("entry").agg(F.count_distinct("place").alias("n")).collect()}
    chosen: list[str] = []
    for row in best:
        entry = row["entry"]
        if spread.get(entry, 0) >= max(SUPPORT, 0.5 * row["toxic"]) and not any(_related(entry, other) for other in chosen):
            chosen.append(entry)
    return chosen[:VOTERS]


def _related(one: str, other: str) -> bool:
    """Whether a word with the longer entry has the shorter one too, so that both would repeat one vote."""
    short, long = sorted((one, other), key=lambda entry: len(entry.rstrip("*")))
    return long.rstrip("*") == short.rstrip("*") or short.endswith("*") and long.startswith(short[:-1])


def _agreement(docs: DataFrame, text: str, lexicon: list[str]) -> np.ndarray:
    """How many documents of the corpus each two voters vote on together; voters' own counts on the diagonal."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = _voters(lexicon)
        pairs: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid:
                    voted = voters.votes(value.as_py())
                    pairs.update(a * voters.size + b for i, a in enumerate(voted) for b in voted[i:])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (pairs.keys(), pairs.values())], names=["pair", "n"])
        give_back()

    size = len(lexicon) + len(_FORMS)
    counts = np.zeros((size, size))
    for row in docs.select(text).mapInArrow(tally, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        a, b = divmod(row["pair"], size)
        counts[a, b] = counts[b, a] = row["n"]
    return counts


def _groups(counts: np.ndarray, least: float = 0.7) -> list[list[int]]:
    """Voters that vote on mostly the same documents, put together; they carry one piece of evidence, not many."""
    alone = np.diag(counts)
    union = alone[:, None] + alone[None, :] - counts
    tied = counts >= least * np.maximum(union, 1)
    groups, left = [], set(range(len(alone)))
    while left:
        group, edge = set(), {min(left)}
        while edge:
            group |= edge
            edge = {int(j) for i in edge for j in np.flatnonzero(tied[i])} - group
        groups.append(sorted(group))
        left -= group
    return groups


def _label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30, counts: np.ndarray | None = None):
    """Posterior labels, the prior, and how often each group and the given label vote on toxic and on other rows.

    ``votes`` is rows by groups of voters. The given label starts as the best voter; what it is worth is estimated as for any.
    A lexicon entry that a text lacks is no vote for the other class, as texts differ in length and language; so the
    prior is the labelled share, and the label's own error stays within bounds. ``counts`` says how many rows each row
    stands for, one by default.
    """
    counts = np.ones(len(labels)) if counts is None else counts
    total = counts.sum()
    joint = np.column_stack([votes, labels > 0]).astype(float)
    posterior = np.where(labels > 0, 0.95, 0.05)
    prior = (counts @ (labels > 0) + 1) / (total + 2)
    for _ in range(rounds):
        weight = counts @ posterior
        on_toxic = ((counts * posterior) @ joint + 0.5) / (weight + 1)
        on_other = ((counts * (1 - posterior)) @ joint + 0.05) / (total - weight + 1)
        on_toxic[-1], on_other[-1] = np.clip(on_toxic[-1], 0.6, 0.99), np.clip(on_other[-1], 0.001, 0.1)
        logit = np.log(prior / (1 - prior)) + joint @ np.log(on_toxic / on_other)
        logit += (1 - joint[:, -1]) * np.log((1 - on_toxic[-1]) / (1 - on_other[-1]))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior, prior, on_toxic, on_other


def _regress(
    features: np.ndarray, target: np.ndarray, ridge: float = 0.02, rounds: int = 60, counts: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Logistic regression of posterior labels on features by Newton steps; ``counts`` as in :func:`_label_model`."""
    counts = np.ones(len(target)) if counts is None else counts
    x = np.column_stack([features.astype(float), np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - target)) + penalty * w
        step = np.linalg.solve((x * (counts * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn from labelled rows; ``labels`` has the key and 0 or 1. Rows whose crc32(key) mod 3 is 1 are never used.

    Without labelled rows of both classes the known insults decide alone.
    """
    sample, totals = _sample(docs, training_labels(labels, key, label), key, text)
    mined = _mine(sample)
    lexicon = list(dict.fromkeys([*mined, *INSULTS]))
    size = len(lexicon) + len(_FORMS)
    shared = list(lexicon)

    def ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = _voters(shared)
        for batch in batches:
            voted = pa.array([voters.votes(x.as_py()) for x in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), voted], names=["label", "votes"])
        give_back()

    rows = sample.select("label", "text").mapInArrow(ballots, "label int, votes array<int>").toArrow()  # SAMPLE rows
    given = rows.column("label").to_numpy()
    if not mined:
        known = np.zeros(size + 1)
        known[: len(lexicon)] = 4.0
        return Model(lexicon, known, -3.0, groups=[[v] for v in range(size)])
    votes = np.zeros((len(given), size), bool)
    for i, voted in enumerate(rows.column("votes").to_pylist()):
        votes[i, voted] = True
    order = np.lexsort((*votes.T[:64], given))  # the order rows arrive in must not move a rounding
    votes, given = votes[order], given[order]
    groups = _groups(_agreement(docs, text, lexicon))
    joint = np.column_stack([votes[:, group].any(axis=1) for group in groups])
    # Where a class was cut to its half, a sampled row stands for several; 1 otherwise.
    stands_for = {y: n / max(1, (given == y).sum()) for y, n in totals.items()}
    counts = np.array([stands_for[y] for y in given])
    posterior, prior, on_toxic, on_other = _label_model(joint, given, counts=counts)
    weights, bias = _regress(np.column_stack([joint, joint.sum(axis=1)]), posterior, counts=counts)
    return Model(lexicon, weights, bias, prior, on_toxic, on_other, groups)


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of the whole text. Null and empty texts get the score of a text without votes.

    A column named like ``out`` is replaced; other columns and repeated rows pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # VOTERS entries and weights

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        voters = _voters(model.lexicon)
        return tidy(pa.array([model.score(voters, x.as_py() or "") for x in batch], pa.float64()) for batch in batches)

    return docs.withColumn(out, scores(F.col(text)))

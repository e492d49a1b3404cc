"""Runs of periodic words by a dictionary of basic factors.

A basic factor is a stretch of ``2 ** k`` words; factors of one length get equal names where they are equal, made from the
names of their two halves. Occurrences of a factor whose successors lie at equal distances, no more than twice its length,
form an arithmetic progression, and its difference is proposed as a period. A run of period ``q`` and at least ``4 * q`` words
holds three occurrences, ``q`` apart, of each factor of the least length ``2 ** k >= q`` at its start, so it is proposed.
Proposals that overlap by more than a period are one run; each is extended word by word to both sides, and runs found at
several lengths are one. The difference is the smallest period of its run: with a smaller one the factor would recur sooner.
Factors with fewer than three occurrences in a text take no part in longer ones, so most texts end after a few lengths.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that are worked on at once, about; a longer text is worked on alone.
AT_ONCE = 400_000
#: The least number of periods in a run, and the least number of words.
PERIODS, SHORTEST = 4, 6

Run = tuple[int, int, int]
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


class Factors:
    """The texts' words as numbers, one after the other, with the runs found in them."""

    def __init__(self, texts: Sequence[list[bytes]]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.text = np.repeat(np.arange(len(texts)), sizes)
        words = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
        self.words = words.indices.to_numpy().astype(np.int64)
        self.found: set[tuple[int, int]] = set()  # start and period
        self.runs: list[list[Run]] = [[] for _ in texts]

    def search(self) -> list[list[Run]]:
        """Per text its runs as (start, length, period), by start, then period."""
        at, length = np.arange(len(self.words)), 1
        names = self.text * (int(self.words.max(initial=0)) + 1) + self.words  # equal within a text only
        while len(at):
            order = np.argsort(names, kind="stable")
            by_name, sorted_at = names[order], at[order]
            new = np.flatnonzero(np.diff(by_name, prepend=-1))
            counts = np.diff(new, append=len(at))
            self._propose(by_name, sorted_at, length)
            ranks = np.repeat(np.arange(len(new)), counts)
            often = np.repeat(counts > 2, counts)
            kept = np.full(len(self.words), -1, np.int64)  # the name of the factor at each place, if it occurs often
            kept[sorted_at[often]] = ranks[often]
            at = np.flatnonzero(kept[: len(kept) - length] >= 0)
            at = at[(kept[at + length] >= 0) & (self.text[at] == self.text[at + length])]
            names = kept[at] * len(new) + kept[at + length]
            length *= 2
        for runs in self.runs:
            runs.sort(key=lambda r: (r[0], r[2]))
        return self.runs

    def _propose(self, names: np.ndarray, at: np.ndarray, length: int) -> None:
        """Extend what progressions of three propose; ``at`` is in order within each name."""
        if len(at) < 3:
            return
        gap = np.diff(at)
        even = (names[2:] == names[:-2]) & (gap[1:] == gap[:-1]) & (gap[:-1] <= 2 * length)
        where = np.flatnonzero(even)
        start, period = at[where], gap[where]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        apart = np.ones(len(start), bool)
        apart[1:] = (np.diff(period) != 0) | (np.diff(start) > period[1:] + length)
        for i, p in zip(start[apart].tolist(), period[apart].tolist(), strict=True):
            self._extend(i, p)

    def _extend(self, at: int, period: int) -> None:
        text = int(self.text[at])
        low, high = int(self.starts[text]), int(self.ends[text])
        words = self.words
        first = at - _equal(words[low:at][::-1], words[low + period : at + period][::-1])
        last = at + _equal(words[at : high - period], words[at + period : high]) + period
        length = last - first
        if length >= max(SHORTEST, PERIODS * period) and (first, period) not in self.found:
            self.found.add((first, period))
            self.runs[text].append((first - low, length, period))


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items are equal; looks ahead in growing steps."""
    done, step = 0, 32
    while done < len(a):
        same = a[done : done + step] == b[done : done + step]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + len(same), 4 * step
    return done


def collapse(words: list[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that lie in a run behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for text in texts:
        words = (text.as_py() or b"").split()
        if group and size + len(words) > AT_ONCE:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


@F.arrow_udf(FOUND)
def _periodic(texts: pa.Array) -> pa.Array:
    ends, flat, collapsed = [0], [], []
    for group in _groups(texts):
        for words, runs in zip(group, Factors(group).search(), strict=True):
            flat += runs
            ends.append(len(flat))
            collapsed.append(b" ".join(collapse(words, runs)))
    columns = np.array(flat, np.int64).reshape(-1, 3).T
    run = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), run)
    large = sum(map(len, collapsed)) > 2**31 - 1
    texts = pa.array(collapsed, pa.large_binary() if large else pa.binary())
    return pa.StructArray.from_arrays([lists, texts.cast(pa.large_string() if large else pa.string())], ["runs", "collapsed"])


def periodic(text: Column | str) -> Column:
    """A struct of a text's ``runs`` (start, length and period in words, by start, then period) and the ``collapsed`` text.

    Words are what ASCII white space parts. A run is a longest stretch whose words ``period`` apart are equal, with no
    smaller period, of at least four periods and six words; runs may overlap. The collapsed text has the words outside runs
    and the first period of each run that no other run drops, joined by a blank. Null and empty texts, and texts without
    words, have no runs and an empty collapsed text. Each text counts alone, so repeated rows have equal results.
    """
    return _periodic((F.col(text) if isinstance(text, str) else text).cast("binary"))


def strongest(runs: Column) -> Column:
    """The run of most periods, compared exactly; the first of ties, null without runs."""
    none = F.lit(None).cast(RUN)
    more = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(runs, none, lambda a, b: F.when(more(a, b), b).otherwise(a))

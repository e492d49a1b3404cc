"""Language model scores from a hierarchical Pitman-Yor model, sampled by Gibbs.

The model is a tree of Chinese restaurants. A token is a customer in the restaurant of its context, the word before it;
every table there is a customer of the parent that all contexts share, whose base is uniform over the vocabulary and one
unknown word. A Gibbs sweep removes each customer from its table and seats it again, in the restaurants of the contexts
and in the parent, and predictive probabilities are averaged over the sweeps behind the burn-in.

What is gathered from the corpus is kept by dish: a bucket of words has their counts in all contexts, the tables they
have there, and so all it needs of the parent. A restaurant's dishes lie in many buckets. After each sweep a bucket sends
the numbers of its tables in every context to the context's owner, one of a fourth as many groups; the owner adds them up and
answers with the restaurant's number. Within a sweep a bucket sees its own changes to these numbers, those of others from
the next sweep on. Buckets and owners stay where they are stored (bucketed tables); only numbers move.

Tokens never travel one by one. A block of documents counts its own (word before, word) pairs and sends each to its word's
bucket; after sampling, the bucket answers with one probability per pair asked for, and the block adds them up over its
documents.
"""

from __future__ import annotations

import itertools
import random
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import binary_array, give_back, partitions, stored
from dimflow.storage import scratch_dir

#: Tokens of a block; tokens of a task that are counted for short names, and the name of words without one.
BLOCK, NAMING, UNNAMED = 1 << 20, 1 << 15, 0xFFFF
#: Sweeps, those of them that are not averaged, and the strength of both levels.
SWEEPS, BURN_IN, STRENGTH = 4, 1, 1.0
#: Buckets to one owner of contexts' numbers; each bucket and each owner exchange one row.
BUCKETS_TO_OWNER = 4
#: So few dishes that still have customers to move go through theirs one by one.
FEW = 24

_END = b""


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed blob; bytes of equal weight lie together, as the high ones are mostly zero."""
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], "<i8").tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *planes]))


def _unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * count, 8).reshape(-1, 2)
    at, out = 8 + 16 * count, []
    for code, size in head.tolist():
        kind = np.dtype(chr(code))
        planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * kind.itemsize
    return out


def held_out(key: int | None) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 7 == 2


class _Block:
    """Documents that are counted and scored together."""

    def __init__(self):
        self.keys, self.sizes, self.words = [], [], []

    def add(self, key: int | None, text: str) -> None:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
        self.words += words
        self.words.append(_END)
        self.keys.append(key)
        self.sizes.append(len(words) + 1)

    def rows(self, block: int, buckets: int, short: np.ndarray) -> Iterator[tuple]:
        """The block's own row, and one row of requests per bucket.

        Pairs are numbered by bucket, word and word before, both in order of hashes, so answers in order of buckets are in
        order of pairs. A word before is named by its place in ``short``, or by its hash if it has none.
        """
        known = dict.fromkeys(self.words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        order = np.lexsort((hashes, hashes % np.uint64(buckets)))
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        index = dict(zip(known, place.tolist(), strict=True))
        hashes = hashes[order]
        by_hash = np.argsort(hashes)
        rank = np.empty(len(known), np.int64)
        rank[by_hash] = np.arange(len(known))
        tokens = np.fromiter(map(index.__getitem__, self.words), np.int64, len(self.words))
        sizes = np.array(self.sizes, np.int64)
        before = rank[np.roll(tokens, 1)]
        before[np.cumsum(sizes) - sizes] = rank[index[_END]]  # a document begins as if an end stood before it
        pairs, inverse = np.unique(tokens * len(known) + before, return_inverse=True)
        learned = np.repeat([not held_out(k) for k in self.keys], sizes)
        counts = np.bincount(inverse[learned], minlength=len(pairs)).astype(np.uint32)
        word, context = np.divmod(pairs, len(known))
        per_word = np.bincount(word, minlength=len(hashes)).astype(np.uint32)
        names = _names(hashes[by_hash], short)
        yield block, -1 - block % buckets, self.keys, _pack(sizes, inverse.astype(np.uint32), per_word)
        buckets_of = (hashes % np.uint64(buckets)).astype(np.int64)
        first = np.searchsorted(buckets_of, np.arange(buckets + 1))
        starts = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])
        for bucket in range(buckets):
            a, b = first[bucket], first[bucket + 1]
            if a < b:
                p, q = starts[a], starts[b]
                named = names[context[p:q]]
                long = hashes[by_hash[context[p:q][named == UNNAMED]]]
                yield block, bucket, [], _pack(hashes[a:b], per_word[a:b], named, long, counts[p:q])


def _names(hashes: np.ndarray, short: np.ndarray) -> np.ndarray:
    """The place of each hash in ``short``, ``UNNAMED`` for those that are not in it."""
    if not len(short):
        return np.full(len(hashes), UNNAMED, np.uint16)
    order = np.argsort(short)
    at = order[np.minimum(np.searchsorted(short, hashes, sorter=order), len(short) - 1)]
    return np.where(short[at] == hashes, at, UNNAMED).astype(np.uint16)


_ROW = "block long, bucket int, keys array<bigint>, payload binary"
_ROW_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.list_(pa.int64())), ("payload", pa.binary())])


def _short_names(texts: DataFrame) -> np.ndarray:
    """Hashes of words that stand often in the first texts of some tasks, the most frequent first.

    They only shorten what blocks send: a word before takes two bytes instead of eight. Any list gives the same results.
    """

    def first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches if TaskContext.get().partitionId() < 32 else ():
            for x in batch.column(0):
                block.add(None, x.as_py() or "")
                if len(block.words) >= NAMING:
                    break
            break
        found = Counter(block.words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(found.values()), pa.int64())], names=["hash", "n"])

    counts = texts.mapInArrow(first_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "hash").limit(UNNAMED).collect()  # a fixed number
    return np.array([row["hash"] for row in rows], np.int64).view(np.uint64)


@dataclass
class State:
    """What buckets know of each other: counts of the corpus, discounts, and tables after a sweep.

    ``customers`` and ``tables`` are those of the restaurants that a bucket's pairs stand in, summed over all buckets.
    """

    tokens: int
    vocabulary: int
    customers: np.ndarray | None
    discount: float
    parent_discount: float
    tables: np.ndarray | None
    parent_customers: float
    parent_tables: float

    def base(self) -> float:
        """Weight of the uniform base in the parent, per word."""
        return (STRENGTH + self.parent_discount * self.parent_tables) / (self.vocabulary + 1)


@dataclass
class Seats:
    """How many tables each dish has, and how many customers sit at each of them, dish by dish."""

    tables: np.ndarray
    sizes: np.ndarray

    @classmethod
    def empty(cls, dishes: int) -> Seats:
        return cls(np.zeros(dishes, np.int64), np.zeros(0, np.int64))


@dataclass
class Fixed:
    """New tables whose weight does not depend on the tables there are."""

    mass: np.ndarray

    def of(self, dishes: np.ndarray) -> Fixed:
        return Fixed(self.mass[dishes])

    def weight(self, dishes):
        return self.mass[dishes]

    def changed(self, dishes, by: int) -> None:
        pass


@dataclass
class Below:
    """New tables in the restaurants of contexts: their weight follows the tables of the restaurant and of the word."""

    state: State
    context: np.ndarray
    word: np.ndarray
    tables: np.ndarray
    customers: np.ndarray
    parent_tables: np.ndarray

    def of(self, dishes: np.ndarray) -> Below:
        """The same with ``dishes`` as its dishes; tables and customers are shared."""
        return replace(self, context=self.context[dishes], word=self.word[dishes])

    def weight(self, dishes):
        state, word = self.state, self.word[dishes]
        customers = self.customers[word]
        parent = customers - state.parent_discount * np.minimum(self.parent_tables[word], customers) + state.base()
        return (STRENGTH + state.discount * self.tables[self.context[dishes]]) * parent / (STRENGTH + state.parent_customers)

    def changed(self, dishes, by: int) -> None:
        np.add.at(self.tables, self.context[dishes], by)
        np.add.at(self.customers, self.word[dishes], by)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``lengths[i]`` numbers from ``starts[i]`` on, for each ``i`` in turn."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def reseat(seats: Seats, counts: np.ndarray, menu: Fixed | Below, discount: float, rng: np.random.Generator) -> Seats:
    """A Gibbs sweep over dishes with ``counts`` customers: one after the other is removed and seated again.

    A customer sits down at a table of ``s`` others with weight ``s - discount`` and at a new one with the weight that
    ``menu`` gives; a table that loses its last customer is gone. Dishes take turns: the first customers of all dishes
    move, then the second ones, and each turn sees the tables that the turn before left; the last few dishes, with the
    most customers, go through the rest of theirs one by one. Where ``counts`` is below the customers seated, some leave
    at random, and where it is above, new ones are seated without being removed. A table is found by picking one of the
    dish's other customers and accepting its table with probability ``(s - discount) / s``.
    """
    begin = np.cumsum(counts) - counts
    room = seats.tables + counts  # every customer may open one more
    first = np.cumsum(room) - room
    size = np.zeros(int(room.sum()), np.int64)
    dish = np.repeat(np.arange(len(counts)), seats.tables)
    slots = _runs(first, seats.tables)
    size[slots] = seats.sizes
    place, who = np.repeat(slots, seats.sizes), np.repeat(dish, seats.sizes)
    had = np.bincount(who, minlength=len(counts))
    number = _runs(np.zeros_like(had), had)
    alive = seats.tables.astype(np.int64)
    mixed = np.flatnonzero(seats.tables[who] > 1)  # who moves first must not depend on the table
    place[mixed] = place[mixed[np.argsort(who[mixed] + rng.random(len(mixed)))]]
    if (had > counts).any():
        stays = number < counts[who]
        size -= np.bincount(place[~stays], minlength=len(size))
        alive -= np.bincount(dish[size[slots] == 0], minlength=len(counts))
        place, who, number = place[stays], who[stays], number[stays]
        had = np.minimum(had, counts)
    at = np.full(int(counts.sum()), -1)
    at[begin[who] + number] = place
    del place, who, number, slots, dish
    movable = np.flatnonzero((counts > 1) | (counts > had))  # a single customer comes back to a table of its own
    movable = movable[np.argsort(-counts[movable], kind="stable")]
    menu, rising = menu.of(movable), -counts[movable]
    begin, room, first, had = begin[movable], room[movable], first[movable], had[movable]
    tables, top = alive[movable], (first + seats.tables[movable])
    full = bool((had + rising == 0).all())  # no new customers
    for turn in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(rising, -turn))  # those with customers left come first
        if live < FEW:
            for i in range(live):
                a, b = slice(begin[i], begin[i] - rising[i]), slice(first[i], first[i] + room[i])
                size[b], tables[i] = _one_by_one(i, turn, int(had[i]), at[a] - first[i], size[b], int(tables[i]), menu, discount, rng)
            break
        customer = begin[:live] + turn
        if not full:
            seated = np.flatnonzero(turn < had[:live])
            left = at[customer[seated]]
            others = np.maximum(had[:live] - 1, turn)
        else:  # all of them sit
            left, others = at[customer], -rising[:live] - 1
        after = size[left] - 1
        size[left] = after
        closed = np.flatnonzero(after == 0)
        closed = closed if full else seated[closed]
        tables[closed] -= 1
        menu.changed(closed, -1)
        weight = menu.weight(slice(0, live))
        opens = rng.random(live) * (weight + others - discount * tables[:live]) < weight
        new = np.flatnonzero(opens)
        at[customer[new]] = top[new]
        size[top[new]] = 1
        top[new] += 1
        tables[new] += 1
        menu.changed(new, 1)
        rest = np.flatnonzero(~opens)
        while len(rest):
            pick = (rng.random(len(rest)) * others[rest]).astype(np.int64)
            pick += pick >= turn
            table = at[begin[rest] + pick]
            there = size[table]
            sits = rng.random(len(rest)) * there < there - discount
            found = table[sits]
            size[found] += 1
            at[customer[rest[sits]]] = found
            rest = rest[~sits]
    alive[movable] = tables
    return Seats(alive, size[size > 0])


def _one_by_one(
    dish: int, turn: int, had: int, at: np.ndarray, size: np.ndarray, alive: int, menu: Fixed | Below, discount: float, rng: np.random.Generator
) -> tuple[np.ndarray, int]:
    """The rest of a sweep over one dish, from its customer ``turn`` on: sizes of its tables and their number."""
    draw = random.Random(int(rng.integers(1 << 62))).random
    top = int(np.flatnonzero(size)[-1]) + 1 if size.any() else 0
    at, sizes, one = at.tolist(), size.tolist(), np.array([dish])
    weight = float(menu.weight(one)[0])
    for customer in range(turn, len(at)):
        if customer < had:
            table = at[customer]
            sizes[table] -= 1
            if not sizes[table]:
                alive -= 1
                menu.changed(one, -1)
                weight = float(menu.weight(one)[0])
        others = max(had - 1, customer)
        if not others or draw() * (weight + others - discount * alive) < weight:
            at[customer], sizes[top] = top, 1
            top += 1
            alive += 1
            menu.changed(one, 1)
            weight = float(menu.weight(one)[0])
            continue
        while True:
            pick = int(draw() * others)
            table = at[pick + (pick >= customer)]
            if draw() * sizes[table] < sizes[table] - discount:
                break
        sizes[table] += 1
        at[customer] = table
    return np.array(sizes, np.int64), alive


def seat(counts: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes whose ``counts`` customers come into empty rooms, when ``mass`` is the weight of opening a new one."""
    return reseat(Seats.empty(len(counts)), counts, Fixed(mass), discount, rng).tables


@dataclass
class Bucket:
    """Words of a bucket with their counts by context, their tables there and in the parent."""

    number: int
    words: np.ndarray
    word: np.ndarray  # of each pair
    context: np.ndarray
    count: np.ndarray
    contexts: np.ndarray = field(default=None)  # hashes of the words before
    tables: np.ndarray = field(default=None)
    several: Seats = field(default=None)  # of the pairs with more than one customer
    parent: Seats = field(default=None)

    def begin(self) -> None:
        """One table per dish and restaurant."""
        self.tables = (self.count > 0).astype(np.int64)
        counts = self.count[self.count > 1]
        self.several = Seats(np.ones(len(counts), np.int64), counts)
        customers = self.customers()
        self.parent = Seats((customers > 0).astype(np.int64), customers[customers > 0])

    def resume(self, state: bytes) -> None:
        """The seats that ``kept`` packed."""
        seats = [a.astype(np.int64) for a in _unpack(state)]
        self.several, self.parent = Seats(*seats[:2]), Seats(*seats[2:])
        self._count_tables()

    def kept(self) -> bytes:
        seats = (self.several.tables, self.several.sizes, self.parent.tables, self.parent.sizes)
        return _pack(*[a.astype(np.uint64) for a in seats])

    def _count_tables(self) -> None:
        self.tables = (self.count > 0).astype(np.int64)
        self.tables[self.count > 1] = self.several.tables

    def customers(self) -> np.ndarray:
        """Customers of the parent: the tables of each word below."""
        return np.bincount(self.word, self.tables, len(self.words)).astype(np.int64)

    def opening(self, state: State) -> np.ndarray:
        """The weight of a new table for each pair: strength and tables of its restaurant times the parent's prediction."""
        parent = (self.customers() - state.parent_discount * self.parent.tables + state.base()) / (STRENGTH + state.parent_customers)
        return (STRENGTH + state.discount * state.tables[self.context]) * parent[self.word]

    def sweep(self, state: State, turn: int) -> None:
        """Every customer of every restaurant is removed and seated again, then every customer of the parent."""
        rng = np.random.default_rng([17, self.number, turn])
        pairs = np.flatnonzero(self.count > 1)
        tables = state.tables.astype(np.float64)
        menu = Below(state, self.context[pairs], self.word[pairs], tables, self.customers(), self.parent.tables)
        self.several = reseat(self.several, self.count[pairs], menu, state.discount, rng)
        self._count_tables()
        self.parent = reseat(self.parent, self.customers(), Fixed(np.full(len(self.words), state.base())), state.parent_discount, rng)

    def predictive(self, state: State) -> np.ndarray:
        return (self.count - state.discount * self.tables + self.opening(state)) / (STRENGTH + state.customers[self.context])


def _merge(table: pa.Table, short: np.ndarray) -> tuple[Bucket, list[int], list[np.ndarray]]:
    """A bucket from its requests, and for each block the bucket's pairs that it asked for, in its order."""
    requests = [_unpack(blob) for blob in table.column("payload").to_pylist()]
    words, at = np.unique(np.concatenate([r[0] for r in requests]), return_inverse=True)
    per_word = np.concatenate([r[1] for r in requests]).astype(np.int64)
    names = np.concatenate([r[2] for r in requests])
    named = np.empty(len(names), np.uint64)
    named[names != UNNAMED] = short[names[names != UNNAMED]]
    named[names == UNNAMED] = np.concatenate([r[3] for r in requests])
    contexts, context = np.unique(named, return_inverse=True)
    pairs = np.repeat(at, per_word) * len(contexts) + context
    merged, inverse = np.unique(pairs, return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([r[4] for r in requests]), len(merged)).astype(np.int64)
    ends = np.cumsum([len(r[2]) for r in requests])
    word, context = np.divmod(merged, len(contexts))
    bucket = Bucket(table.column("bucket")[0].as_py(), words, word, context, counts, contexts)
    return bucket, table.column("block").to_pylist(), np.split(inverse, ends[:-1])


_GATHERED = "bucket int, block long, keys array<bigint>, payload binary, blocks array<bigint>, asked array<binary>, own boolean"
_GATHERED_NAMES = [part.split()[0] for part in _GATHERED.split(", ")]
_GATHERED_ARROW = pa.schema(
    [*_ROW_ARROW, ("blocks", pa.list_(pa.int64())), ("asked", pa.list_(pa.binary())), ("own", pa.bool_())]
)


def _pack_model(bucket: Bucket) -> bytes:
    per_word = np.bincount(bucket.word, minlength=len(bucket.words))
    return _pack(bucket.words, per_word.astype(np.uint32), bucket.context.astype(np.uint32), bucket.count.astype(np.uint64), bucket.contexts)


def _bucket(number: int, model: bytes) -> Bucket:
    words, per_word, context, count, contexts = _unpack(model)
    word = np.repeat(np.arange(len(words)), per_word)
    return Bucket(number, words, word, context.astype(np.int64), count.astype(np.int64), contexts)


#: Customers and tables of the parent, tokens, vocabulary, pairs and words with one and two customers.
SCALARS = ("C", "T", "N", "V", "n1", "n2", "m1", "m2")

#: What buckets say after a sweep: their seats and sums (owner -1), and for each owner the tables in its contexts.
_SAID = "turn int, bucket int, owner int, payload binary, sums array<double>"
_SAID_ARROW = pa.schema(
    [("turn", pa.int32()), ("bucket", pa.int32()), ("owner", pa.int32()), ("payload", pa.binary()), ("sums", pa.list_(pa.float64()))]
)


def _owners(contexts: np.ndarray, width: int) -> tuple[np.ndarray, list[int], list[np.ndarray]]:
    """The order of contexts by owner, the owners, and the places of each one's contexts."""
    owner = (contexts % np.uint64(-(-width // BUCKETS_TO_OWNER))).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    owners, begins = np.unique(owner[order], return_index=True)
    return order, owners.tolist(), np.split(order, begins[1:])


def _say(bucket: Bucket, turn: int, width: int) -> pa.Table:
    customers = bucket.customers()
    known = np.bincount(bucket.word, bucket.count, len(bucket.words)) > 0
    sums = [
        customers.sum(), bucket.parent.tables.sum(), bucket.count.sum(), known.sum(),
        *((bucket.count == k).sum() for k in (1, 2)), *((customers == k).sum() for k in (1, 2)),
    ]
    rows = [{"turn": turn, "bucket": bucket.number, "owner": -1, "payload": bucket.kept(), "sums": [float(x) for x in sums]}]
    numbers = [np.bincount(bucket.context, n, len(bucket.contexts)).astype(np.uint64) for n in (bucket.tables, bucket.count)]
    numbers = numbers if turn == 0 else numbers[:1]  # customers stay the same
    _, owners, places = _owners(bucket.contexts, width)
    for owner, at in zip(owners, places, strict=True):
        rows.append({"turn": turn, "bucket": bucket.number, "owner": owner, "payload": _pack(*[n[at] for n in numbers]), "sums": None})
    return pa.Table.from_pylist(rows, schema=_SAID_ARROW)


def _discount(once: float, twice: float) -> float:
    """The usual estimate from how many dishes have one customer and two."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _bucketed(df: DataFrame, label: str, width: int, by: str, *folders: str) -> DataFrame:
    """``df`` stored like ``stored`` in ``width`` buckets of ``by``, so that grouping by it does not move it again.

    The table's name stays in the session's catalog, as results that are yet to be computed look it up.
    """
    name, path = f"{label}_{uuid.uuid4().hex}", scratch_dir(df.sparkSession, label)
    df.write.option("path", path).partitionBy(*folders).bucketBy(width, by).saveAsTable(name)
    return df.sparkSession.table(name)


def _unsaid(part: pa.Table) -> tuple[dict[int, bytes], dict[int, dict[int, list[np.ndarray]]]]:
    """Seats by turn, and the owners' answers by turn and owner, from what a bucket is told."""
    seats, answers = {}, {}
    for row in part.to_pylist():
        if row["owner"] < 0:
            seats[row["turn"]] = row["payload"]
        else:
            answers.setdefault(row["turn"], {})[row["owner"]] = _unpack(row["payload"])
    return seats, answers


def _gathered(bucket: Bucket, answers: dict[int, list[np.ndarray]], which: int, width: int) -> np.ndarray:
    """Numbers of the bucket's contexts, from their owners' answers."""
    order, owners, _ = _owners(bucket.contexts, width)
    numbers = np.empty(len(order), np.float64)
    numbers[order] = np.concatenate([answers[owner][which] for owner in owners])
    return numbers


class Sampler:
    """Gibbs sweeps over stored buckets, and the numbers of restaurants that pass between them."""

    def __init__(self, buckets: DataFrame, width: int):
        self.models, self.width = buckets, width
        self.routes = _bucketed(self._routes(), "routes", width, "owner")
        self.states: list[State] = []
        self.told: list[DataFrame] = []
        self.first: dict = {}

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, model in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    bucket = _bucket(number, model)
                    bucket.begin()
                    yield from _say(bucket, 0, width).to_batches()

        self._said(buckets.select("bucket", "payload").mapInArrow(start, _SAID))

    def _routes(self) -> DataFrame:
        """For each owner its buckets, and where their contexts stand among all of the owner's."""
        width = self.width

        def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, model in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    hashes = _unpack(model)[4]
                    _, owners, places = _owners(hashes, width)
                    for owner, at in zip(owners, places, strict=True):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([owner], pa.int32()), pa.array([number], pa.int32()), binary_array([_pack(hashes[at])])],
                            names=["owner", "bucket", "payload"],
                        )

        def meet(table: pa.Table) -> pa.Table:
            hashes = [_unpack(blob)[0] for blob in table.column("payload").to_pylist()]
            _, at = np.unique(np.concatenate(hashes), return_inverse=True)
            places = np.split(at, np.cumsum([len(h) for h in hashes])[:-1])
            blobs = [_pack(np.diff(p, prepend=0).astype(np.uint32)) for p in places]
            return table.select(["owner", "bucket"]).append_column("places", binary_array(blobs))

        sent = self.models.select("bucket", "payload").mapInArrow(contexts, "owner int, bucket int, payload binary")
        return sent.groupBy("owner").applyInArrow(meet, "owner int, bucket int, places binary")

    def _said(self, said: DataFrame) -> None:
        """Store what buckets say, add it up, and lay down what they are told: owners' answers and their own seats."""
        turn, said = len(self.states), stored(said, "said")
        seats = said.filter("owner < 0")
        sums = seats.agg(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0.0)) for i in range(len(SCALARS))]).first()
        named = dict(zip(SCALARS, sums, strict=True))
        first = self.first = self.first or named
        self.states.append(
            State(
                tokens=int(first["N"]),
                vocabulary=int(first["V"]),
                customers=None,
                discount=_discount(first["n1"], first["n2"]),
                parent_discount=_discount(first["m1"], first["m2"]),
                tables=None,
                parent_customers=named["C"],
                parent_tables=named["T"],
            )
        )

        def add(routes: pa.Table, said: pa.Table) -> pa.Table:
            places = {b: np.cumsum(_unpack(p)[0]) for b, p in zip(*routes.select(["bucket", "places"]).to_pydict().values(), strict=True)}
            size = max((int(p[-1]) for p in places.values()), default=-1) + 1
            rows = [(row["bucket"], _unpack(row["payload"])) for row in said.select(["bucket", "payload"]).to_pylist()]
            totals = []
            for which in range(len(rows[0][1]) if rows else 0):
                total = np.zeros(size, np.uint64)
                for number, numbers in rows:
                    total[places[number]] += numbers[which]  # places of a bucket are distinct
                totals.append(total)
            answers = [
                {"turn": turn, "bucket": number, "owner": said.column("owner")[0].as_py(), "payload": _pack(*[t[places[number]] for t in totals]), "sums": None}
                for number, _ in rows
            ]
            return pa.Table.from_pylist(answers, schema=_SAID_ARROW)

        up = said.filter("owner >= 0").groupBy("owner")
        answers = self.routes.groupBy("owner").cogroup(up).applyInArrow(add, _SAID)
        self.told.append(answers.unionByName(seats))

    def sweep(self) -> None:
        turn, width = len(self.states) - 1, self.width
        state = self.states[turn]

        def seat_all(model: pa.Table, told: pa.Table) -> pa.Table:
            bucket = _bucket(model.column("bucket")[0].as_py(), model.column("payload")[0].as_py())
            seats, answers = _unsaid(told)
            bucket.resume(seats[turn])
            bucket.sweep(replace(state, tables=_gathered(bucket, answers[turn], 0, width)), turn)
            said = _say(bucket, turn + 1, width)
            give_back()
            return said

        models = self.models.select("bucket", "payload").groupBy("bucket")
        self._said(models.cogroup(self.told[turn].groupBy("bucket")).applyInArrow(seat_all, _SAID))


def score(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learning uses rows whose crc32(key) mod 7 is not 2; a null key counts as empty text. Null and empty texts are one
    end. ``base_score`` is the add-one unigram score. Repeated rows count and are scored each; an empty table gives an
    empty table; other columns are not looked at. There are as many buckets as shuffle partitions.
    """
    spark = docs.sparkSession
    width = partitions(spark)
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    names = spark.sparkContext.broadcast(_short_names(slim.select("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, block = itertools.count(TaskContext.get().partitionId() << 32), _Block()

        def flush() -> Iterator[pa.RecordBatch]:
            for row in block.rows(next(numbers), width, names.value):
                yield pa.RecordBatch.from_pylist([dict(zip(_ROW_ARROW.names, row, strict=True))], schema=_ROW_ARROW)

        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(k, x.as_py() or "")
                if len(block.words) >= BLOCK:
                    yield from flush()
                    block = _Block()
        if block.keys:
            yield from flush()
        del block
        give_back()

    def gather(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:  # blocks' own rows
            rows = [row | {"blocks": None, "asked": None, "own": True} for row in table.to_pylist()]
            return pa.Table.from_pylist(rows, schema=_GATHERED_ARROW).select(_GATHERED_NAMES)
        bucket, blocks, asked = _merge(table, names.value)
        asked = [_pack(np.diff(a, prepend=0).astype(np.uint32)) for a in asked]  # rising
        row = {"bucket": bucket.number, "payload": _pack_model(bucket), "blocks": blocks, "asked": asked, "own": False}
        del bucket
        give_back()
        return pa.Table.from_pylist([row], schema=_GATHERED_ARROW).select(_GATHERED_NAMES)

    counted = slim.mapInArrow(count, _ROW).groupBy("bucket").applyInArrow(gather, _GATHERED)
    gathered = _bucketed(counted, "gathered", width, "bucket", "own")
    buckets = gathered.filter("not own")
    sampler = Sampler(buckets, width)
    for _ in range(SWEEPS):
        sampler.sweep()
    states = sampler.states
    told = sampler.told[BURN_IN + 1]
    for more in sampler.told[BURN_IN + 2 :]:
        told = told.unionByName(more)
    customers = sampler.told[0].filter("owner >= 0")

    def answer(model: pa.Table, told: pa.Table) -> pa.Table:
        row = model.to_pylist()[0]
        bucket = _bucket(row["bucket"], row["payload"])
        seats, answers = _unsaid(told)
        seated = _gathered(bucket, answers[0], 1, width)
        chance = np.zeros(len(bucket.count))
        for turn in range(BURN_IN + 1, SWEEPS + 1):
            bucket.resume(seats[turn])
            chance += bucket.predictive(replace(states[turn], customers=seated, tables=_gathered(bucket, answers[turn], 0, width)))
        logs = np.log10(chance / (SWEEPS - BURN_IN)).astype(np.float32)
        counts = np.bincount(bucket.word, bucket.count, len(bucket.words)).astype(np.uint64)
        payloads = []
        for blob in row["asked"]:
            asked = np.cumsum(_unpack(blob)[0])
            words = bucket.word[asked]
            once = np.flatnonzero(np.diff(words, prepend=-1))
            payloads.append(_pack(logs[asked], counts[words[once]]))
        return pa.table([pa.array(row["blocks"], pa.int64()), pa.array([row["bucket"]] * len(payloads), pa.int32()), binary_array(payloads)],
                        names=["block", "bucket", "payload"])

    models = buckets.select("bucket", "payload", "blocks", "asked").groupBy("bucket")
    answers = models.cogroup(told.unionByName(customers).groupBy("bucket")).applyInArrow(answer, "block long, bucket int, payload binary")
    own = gathered.filter("own").select("block", "keys", "payload")
    state = spark.sparkContext.broadcast(states[0])

    def add(own: pa.Table, answers: pa.Table) -> pa.Table:
        known = state.value
        order = np.argsort(answers.column("bucket").to_numpy())
        parts = [_unpack(answers.column("payload")[int(i)].as_py()) for i in order]
        logs = np.concatenate([p[0] for p in parts]).astype(np.float64)
        counts = np.concatenate([p[1] for p in parts]).astype(np.float64)
        sizes, pairs, per_word = _unpack(own.column("payload")[0].as_py())
        counts = np.repeat(counts, per_word)[pairs]
        begins = np.cumsum(sizes) - sizes
        base = np.log10((counts + 1) / (known.tokens + known.vocabulary + 1))
        keys = own.column("keys").combine_chunks().flatten()
        return pa.table(
            {
                "key": keys,
                "held_out": pa.array([held_out(k) for k in keys.to_pylist()], pa.bool_()),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), begins)),
                "train_tokens": pa.array(np.full(len(sizes), known.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, begins)),
                "score": pa.array(np.add.reduceat(logs[pairs], begins)),
            }
        )

    scored = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        add, "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumnRenamed("key", key)

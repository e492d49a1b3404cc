"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its five-word shingles. Its sketch has ``T`` coordinates, filled in rounds: round ``i`` throws
every shingle into a hashed bin with the value ``i`` plus a hashed fraction, a bin keeps its smallest value, and rounds
``T`` to ``2T - 1`` throw all shingles into bin ``i - T``, so that no bin stays empty and most sets need few rounds. Two
sets agree in a coordinate with the probability of their Jaccard similarity, concentrated as for independent samples.

``BANDS`` bands of ``ROWS`` coordinates give candidate groups; at the least similarity of 0.75 a pair shares none with a
probability of 3e-8. Equal sets become one class beforehand. Within a group pairs are not enumerated: in each
round a group's members are compared with one hub, that which shares most bands with others, and only those of other
components than the hub's. In a group that is still of several components, each member lies in one tile of bounded size,
and only members outside the main component visit the other tiles of their group, where sketches rule out all but likely
pairs. Every link is confirmed on the full sets before it counts, and a pair goes uncompared only if it is connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from dimflow.llm.common import kept, stored, tidy

#: Words of a shingle, bands of a sketch and coordinates of a band.
SHINGLE, BANDS, ROWS = 5, 64, 5
T = BANDS * ROWS
#: Hundredths of the union that must be shared.
LEAST = 75
#: Rounds of hubs before tiles, members and shingles of a tile, and the share of equal coordinates from which a pair of a
#: tile is compared: five standard deviations below the least similarity.
HUBS, TILE, TILE_SHINGLES, LIKELY = 2, 1024, 1 << 22, 0.63

_MOST_SHARED = "struct(fame, id)"  # the same in all groups, so that one hub serves many of them
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers mixed well (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes; remembers the hashes of frequent words up to a bound."""

    def __init__(self, memory: int = 120_000):
        self.memory, self.known = memory, {}

    def shingles(self, text: str) -> np.ndarray:
        """Distinct 64-bit hashes of the text's shingles in ascending order. Fewer words than a shingle are one shingle."""
        words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.memory:
            self.known = {}
        for word in set(words).difference(self.known):
            self.known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(words))
        total = np.full(len(words) - width + 1, np.uint64(width))
        for i in range(width):
            total = _mixed(total * _MIX + hashes[i : len(hashes) - width + 1 + i])
        return np.unique(total)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of sets by rows; an empty set's has the largest value everywhere. All sets go through a round at once."""
    out = np.full((len(sets), T), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    active = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    for i in range(2 * T):
        if not len(active):
            break
        rows = np.repeat(active, [len(sets[a]) for a in active])
        hashed = _mixed(np.concatenate([sets[a] for a in active]) + np.uint64((int(_MIX) * (i + 1)) & 0xFFFFFFFFFFFFFFFF))
        value = np.uint64(i) << np.uint64(40) | hashed >> np.uint64(24)
        if i < T:
            bins = ((hashed & np.uint64(0xFFFFFF)) * np.uint64(T) >> np.uint64(24)).astype(np.int64)
        else:
            bins = np.int64(i - T)
        np.minimum.at(flat, rows * T + bins, value)
        active = active[(out[active] == np.iinfo(np.uint64).max).any(axis=1)]
    return out


def bands(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = _mixed(key * _MIX + parts[:, :, r])
    return key


def _batched(texts: pa.Array, shingler: Shingler, size: int = 400_000) -> Iterator[list[np.ndarray]]:
    """Sets of a batch's texts, so many shingles at a time that the rounds' arrays stay small."""
    sets, total = [], 0
    for value in texts:
        sets.append(shingler.shingles(value.as_py() or ""))
        total += len(sets[-1])
        if total >= size:
            yield sets
            sets, total = [], 0
    if sets:
        yield sets


_SKETCHED = "struct<n:bigint,high:bigint,low:bigint,bands:array<bigint>,bits:binary>"


def _sketched(text: Column) -> Column:
    """Size, 128-bit digest, band keys of a text's set, and eight bits of each coordinate."""

    @F.arrow_udf(_SKETCHED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tidy(sketched(batches))

    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingler = kept("shingler", Shingler)
        for batch in batches:
            sizes, digests, keys, bits = [], [], [], []
            for sets in _batched(batch, shingler):
                sizes += map(len, sets)
                digests += [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                sketches = sketch(sets)
                keys.append(bands(sketches))
                bits += [row.tobytes() for row in _mixed(sketches).astype(np.uint8)]
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            flat = np.concatenate(keys).reshape(-1).view(np.int64) if keys else np.zeros(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), listed, pa.array(bits, pa.binary())],
                names=["n", "high", "low", "bands", "bits"],
            )

    return run(text)


@F.arrow_udf(BinaryType())
def _set_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    shingler = kept("shingler", Shingler)
    return tidy(pa.array([shingler.shingles(x.as_py() or "").tobytes() for x in batch], pa.binary()) for batch in texts)


@F.arrow_udf(BooleanType())
def _similar(a: pa.Array, b: pa.Array) -> pa.Array:
    sets = (np.frombuffer(x.as_buffer(), np.uint64) for pair in zip(a, b, strict=True) for x in pair)
    return pa.array([similar(x, y) for x, y in zip(sets, sets, strict=True)], pa.bool_())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose full sets are similar enough; ``sets`` has (id, set)."""
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    other = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    met = stored(pairs, "pairs").join(one, "a").join(other, "b")
    return stored(met.filter(_similar("set_a", "set_b")).select("a", "b"), "verified")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets share ``LEAST`` hundredths of their union at least."""
    if 100 * min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= LEAST * (len(a) + len(b) - shared)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b): the smallest id reachable.

    Large-star and small-star steps in turn: every id is linked to the smallest of its neighbourhood, until nothing
    changes; that takes a logarithmic number of steps. Each step is stored, so a lost executor repeats only its own.
    """
    edges, before = _signed(_oriented(links.select("a", "b")))
    if not before[0]:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = _oriented(large)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        small = _oriented(
            small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(small.select("a", F.col("least").alias("b")))
        )
        after, now = _signed(small)
        if now == before:
            return after.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = now
        edges = after


def _signed(links: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """Distinct links, stored, with their number and combined hash, which change whenever the links do."""
    seen = Observation()
    observed = links.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("hash"))
    return stored(observed, "links"), (seen.get["n"], seen.get["hash"])


def _oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger id to the smaller."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Linked documents form components, named by their smallest key; ``kept`` marks that document. Rows without words are
    linked with nothing. Rows that repeat a key are one document, whatever their texts. A row without key takes no part:
    it has no component and is kept. An empty table gives an empty table; other columns are not looked at.
    """
    read = docs.select(F.col(key).cast("long").alias("id"), _sketched(F.col(text)).alias("s"))
    rows = stored(read.select("id", "s.*"), "sketches")
    named = rows.filter("id is not null")
    digest = ["n", "high", "low"]
    classes = named.filter("n > 0").groupBy(*digest).agg(
        F.min("id").alias("class"), F.min_by(F.struct("bands", "bits"), "id").alias("sketch")
    )
    classes = stored(classes.select(*digest, "class", "sketch.bands", "sketch.bits"), "classes")
    placed = stored(
        named.select("id", *digest).join(classes.select(*digest, "class"), digest, "left").select("id", F.coalesce("class", "id").alias("class")),
        "placed",
    )
    several = placed.groupBy("id").agg(F.min("class").alias("first"), F.max("class").alias("last")).filter("first <> last")
    links = stored(placed.join(several, "id", "left_semi").select(F.col("id").alias("a"), F.col("class").alias("b")).filter("a <> b"), "links")

    in_bands = classes.select(F.col("class").alias("id"), F.explode("bands").alias("key"))
    shared = in_bands.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    grouped = stored(in_bands.join(shared, "key"), "members")
    fame = grouped.groupBy("id").agg(F.sum("members").alias("fame"))
    members = stored(grouped.select("key", "id").join(fame, "id"), "members")
    involved = members.select("id").distinct()
    first_text = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(involved, "id", "left_semi")
    sets = stored(first_text.select("id", _set_of(F.col("text")).alias("set")), "sets")

    found = components(links)
    for _ in range(HUBS):
        live = _with_component(members, found)
        hubs = live.groupBy("key").agg(
            F.max_by(F.struct("id", "component"), F.expr(_MOST_SHARED)).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low <> high").select("key", F.col("hub.id").alias("hub"), F.col("hub.component").alias("of"))
        # The hub is compared with every member of another component, so the rest of the group needs it no more.
        members = stored(live.join(hubs, "key").filter("id <> hub").select("key", "id", "fame", "component", "hub", "of"), "members")
        pairs = members.filter("component <> of").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
        confirmed = _verified(pairs, sets)
        members = members.select("key", "id", "fame")
        if confirmed.isEmpty():
            if members.isEmpty():
                break
            continue
        links = stored(links.unionByName(confirmed), "links")
        found = components(links)
    rest = stored(_tiled(_with_component(members, found), classes, sets), "links")
    if not rest.isEmpty():
        found = components(stored(links.unionByName(rest), "links"))

    found = found.select(F.col("id").alias("class"), "component")
    by_id = placed.join(found, "class", "left").groupBy("id").agg(F.min(F.coalesce("component", "class")).alias("component"))
    by_id = by_id.select(F.col("id").alias("named"), "component")
    return rows.join(by_id, F.col("id") == F.col("named"), "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, "id", "left").select("key", "id", "fame", F.coalesce("component", "id").alias("component"))


def _tiled(live: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of a group that are of different components.

    A group's members are dealt into tiles, a row each. Members outside the main component, that of the member which shares most
    bands, are also sent to the group's other tiles, so rows grow with the members, and with the tiles for those few only.
    A task compares the full sets of pairs that sketches call likely and that no link found there connects yet.
    """
    sized = live.join(classes.select(F.col("class").alias("id"), "n", "bits"), "id")
    tiles = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int")
    groups = sized.groupBy("key").agg(
        tiles.alias("tiles"),
        F.max_by("component", F.expr(_MOST_SHARED)).alias("main"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    ).filter("low <> high").select("key", "tiles", "main")
    dealt = sized.join(groups, "key").withColumn("home", F.pmod(F.xxhash64("id"), "tiles").cast("int"))
    visits = F.when(F.col("component") == F.col("main"), F.array("home")).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))
    copies = dealt.withColumn("tile", F.explode(visits)).join(sets, "id")
    copies = copies.select("key", "tile", (F.col("home") == F.col("tile")).alias("lives"), "id", "main", "component", "n", "bits", "set")

    def linked(table: pa.Table) -> pa.Table:
        ids, component, n = (table.column(c).to_numpy() for c in ("id", "component", "n"))
        lives = table.column("lives").to_numpy()
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(ids), T)
        full = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set").combine_chunks()]
        outside = component != table.column("main")[0].as_py()
        component, out = component.copy(), []
        for at in np.flatnonzero(outside):
            # Two outsiders meet in both their tiles; the one of the smaller id looks for the other.
            others = np.flatnonzero(lives & (~outside | (ids > ids[at])) & (component != component[at]))
            small, large = np.minimum(n[others], n[at]), np.maximum(n[others], n[at])
            others = others[100 * small >= LEAST * large]
            equal = (bits[others] == bits[at]).sum(axis=1)
            for near in others[np.argsort(-equal, kind="stable")][: int((equal >= LIKELY * T).sum())]:
                if component[near] != component[at] and similar(full[at], full[near]):
                    out.append((ids[at], ids[near]))
                    component[component == component[near]] = component[at]
        a, b = (np.array(side, np.int64) for side in (zip(*out, strict=True) if out else ((), ())))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return copies.groupBy("key", "tile").applyInArrow(linked, "a long, b long").distinct()

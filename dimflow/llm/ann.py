"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

A tree for each length of vectors is fitted on a bounded sample of them; every vector is then put into the leaf it descends to. A query opens
the nearest unopened node of a priority queue again and again, and each leaf it reaches is a visit. How many visits it
takes is calibrated on the sample: the number is widened until the true neighbours there are found to the wanted share.
Leaves are scanned in Spark, large ones in several parts, with exact distances.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import stored
from dimflow.llm.vectors import best, by_length, matrix, usable

#: Vectors that the tree is fitted on, children of a node, sample vectors aimed for in a leaf, and rows of a part of a leaf.
SAMPLE, BRANCHES, LEAF, PART = 20_000, 8, 40, 8192
#: Queries to calibrate with, and the share of true neighbours they must find.
CALIBRATION, RECALL = 400, 0.985


@dataclass
class Tree:
    """Nodes in one array of centres; ``children`` has first and last child, ``leaf`` a leaf's number or -1."""

    centres: np.ndarray
    children: list[tuple[int, int]]
    leaf: np.ndarray
    visits: int = 1

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to, by the nearest child at every level."""
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[node] < 0)
            if not len(inner):
                return self.leaf[node]
            for parent in np.unique(node[inner]):
                here = inner[node[inner] == parent]
                first, last = self.children[parent]
                node[here] = first + _distances(rows[here], self.centres[first:last]).argmin(axis=1)

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                first, last = self.children[node]
                away = _distances(query[None], self.centres[first:last])[0]
                nearest = int(away.argmin())
                for i, d in enumerate(away):
                    if i != nearest:
                        heapq.heappush(queue, (float(d), first + i))
                node = first + nearest
            yield int(self.leaf[node])


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        nearest = _distances(rows, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        sizes = np.bincount(nearest, minlength=k)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def fit(rows: np.ndarray, k: int, seed: int = 7) -> Tree:
    """A tree over a sample, calibrated for ``k`` neighbours. Equal rows count once; a leaf may hold any number."""
    rows = np.unique(rows, axis=0)
    rng = np.random.default_rng(seed)
    centres, children, leaf = [rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])], [(0, 0)], [-1]
    todo, leaves = [(0, np.arange(len(rows)))], 0
    while todo:
        node, members = todo.pop(0)
        branches = min(BRANCHES, len(members) // (LEAF // 2))
        if len(members) <= LEAF or branches < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        found = _k_means(rows[members], branches, rng)
        nearest = _distances(rows[members], found).argmin(axis=1)
        used = [i for i in range(branches) if (nearest == i).any()]
        if len(used) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        children[node] = (len(centres), len(centres) + len(used))
        for i in used:
            todo.append((len(centres), members[nearest == i]))
            centres.append(found[i])
            children.append((0, 0))
            leaf.append(-1)
    tree = Tree(np.array(centres), children, np.array(leaf))
    tree.visits = _calibrate(tree, rows, k, rng)
    return tree


def _calibrate(tree: Tree, rows: np.ndarray, k: int, rng: np.random.Generator) -> int:
    """Visits after which the sample's own neighbours are found to the wanted share."""
    if len(rows) < 2:
        return 1
    at = tree.assign(rows)
    needed = []
    for q in rng.choice(len(rows), min(CALIBRATION, len(rows)), replace=False):
        away = _distances(rows[q][None], rows)[0]
        away[q] = np.inf
        order = np.empty(tree.leaves, np.int64)
        order[list(tree.visit(rows[q]))] = np.arange(tree.leaves)
        needed += list(order[at[np.argsort(away, kind="stable")[: min(k, len(rows) - 1)]]] + 1)
    return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))])


def _trees(found: DataFrame, k: int) -> dict[int, Tree]:
    """A tree for each number of components.

    Lengths share ``SAMPLE`` by their rows, but none gets less than an equal part of it; rows are taken by a threshold
    on the hash of their ids. A length with few sampled rows has one leaf, which is scanned whole.
    """
    counts = {row["n"]: row["count"] for row in found.groupBy(F.size("vector").alias("n")).count().collect()}
    rows = sum(counts.values())
    wanted = {n: SAMPLE * max(count / rows, 1 / len(counts)) / count for n, count in counts.items()}
    shares = found.sparkSession.createDataFrame(list(wanted.items()), "n int, share double")
    at = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    drawn = found.join(F.broadcast(shares), F.size("vector") == F.col("n")).filter(at < F.col("share"))
    sampled = {n: data for n, _, data in by_length(drawn.limit(3 * SAMPLE).select("vector").toArrow().column(0).combine_chunks())}
    return {n: fit(sampled.get(n, np.zeros((0, n))), k) for n in sorted(counts)}


def search(
    vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", vector: str = "embedding", every_row: bool = False
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest vectors found for each query, nearest first, ties to smaller ids.

    The score is the Euclidean distance in double precision. ``queries`` has the columns of ``vectors``; a row with the
    query's id is no candidate. Of rows that repeat an id one is a candidate, or each with ``every_row``. Vectors of each
    number of components have a tree of their own, and a query meets only those of its length. Rows left out by
    :func:`dimflow.llm.vectors.usable` take no part; an empty side gives an empty result. Where fewer than ``k``
    candidates exist, all are returned. The driver takes a row per length and no more than ``3 * SAMPLE`` vectors, and
    the trees built of them are broadcast.
    """
    spark = vectors.sparkSession
    found = stored(usable(vectors, key=key, vector=vector, zero=False, copies=k if every_row else None), "vectors")
    asked = usable(queries, key=key, vector=vector, zero=False)
    out = "query_id long, vec_id long, score double"
    trees = _trees(found, k)
    if not trees:
        return best(spark.createDataFrame([], out), k, F.asc("score"))
    starts = dict(zip(trees, np.cumsum([0, *(tree.leaves for tree in trees.values())]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((trees, starts))  # leaves of a tree are numbered from its start

    def into_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, starts = shared.value
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int32)
            for n, at, rows in by_length(batch.column(1)):
                leaf[at] = starts[n] + trees[n].assign(rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["id", "vector", "leaf"])

    element = found.schema["vector"].dataType.simpleString()
    indexed = stored(found.mapInArrow(into_leaves, f"id long, vector {element}, leaf int"), "index")
    counts = np.zeros(sum(tree.leaves for tree in trees.values()), np.int64)
    for row in indexed.groupBy("leaf").count().collect():  # one row per leaf of the trees
        counts[row["leaf"]] = row["count"]
    parts = np.maximum(1, -(-counts // PART))

    def open_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, starts = shared.value
        for batch in batches:
            taken, leaf, part = [], [], []
            for n, at, rows in by_length(batch.column(1)):
                if n not in trees:
                    continue
                for i, query in zip(at.tolist(), rows, strict=True):
                    seen = 0
                    for visit, own in enumerate(trees[n].visit(query)):
                        if visit >= trees[n].visits and seen >= 2 * k:  # up to k may be copies of the query
                            break
                        here = starts[n] + own
                        seen += int(counts[here])
                        taken += [i] * int(parts[here])
                        leaf += [here] * int(parts[here])
                        part += range(int(parts[here]))
            columns = [c.take(pa.array(taken, pa.int32())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(leaf, pa.int32()), pa.array(part, pa.int32())], names=["id", "vector", "leaf", "part"])

    visits = asked.mapInArrow(open_leaves, f"id long, vector {element}, leaf int, part int")
    hot = {i: int(n) for i, n in enumerate(parts) if n > 1}
    width = F.coalesce(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])[F.col("leaf")], F.lit(1)) if hot else F.lit(1)
    dealt = indexed.withColumn("part", F.pmod(F.xxhash64("id", "vector"), width).cast("int"))

    def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
        result: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if rows.num_rows and asked.num_rows:
            ids, data = rows.column("id").to_numpy(), matrix(rows.column("vector"))
            order = np.argsort(ids)
            ids, data = ids[order], data[order]
            for query_id, query in zip(asked.column("id").to_numpy(), matrix(asked.column("vector")), strict=True):
                away = np.sqrt(((data - query) ** 2).sum(axis=1))
                away[ids == query_id] = np.inf
                near = np.argsort(away, kind="stable")[:k]
                near = near[np.isfinite(away[near])]
                result.append((np.full(len(near), query_id), ids[near], away[near]))
        columns = [np.concatenate(c) for c in zip(*result, strict=True)] if result else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, types, strict=True)})

    met = dealt.groupBy("leaf", "part").cogroup(visits.groupBy("leaf", "part"))
    return best(met.applyInArrow(scan, out), k, F.asc("score"))

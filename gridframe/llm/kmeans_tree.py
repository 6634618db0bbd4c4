"""Approximate nearest neighbours by cosine over a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row of the table goes to a leaf of
it by descending to the nearest centroid. A query opens nodes best bin first
through a priority queue. How many leaves it visits is calibrated: for a bounded
sample of queries the exact neighbours are found over all rows, and visits widen
until the wished share of them lies in visited leaves.

Copies of a vector are one candidate: only the few smallest ids of each vector
can be among its neighbours, so the rest never meet a query. Equal queries are
searched once. Leaves under one child of the root are compared together, in
blocks of rows and of queries of bounded size: a query goes to each such cell
once, with the list of leaves it visits there, and each block gives at most the
wished number of neighbours per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.vectors import blocks_for, finite_vectors, matrix
from gridframe.operators.extent import checkpoint_once

# Rows the tree is fitted on, and queries the visits are calibrated with.
SAMPLE_ROWS, CALIBRATION_QUERIES = 16_384, 256
# Children of a node; a node of so few sampled rows is a leaf.
CHILDREN, LEAF_ROWS = 16, 48
# Share of the exact neighbours of the calibration queries that visited leaves must hold.
RECALL = 0.96
# Rows of a cell, and queries that visit it, that meet in one group, on average.
BLOCK_ROWS = 4_096
# Scores this close to the last place are computed again, one by one, before they are ranked.
CLOSE = 1e-9


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the centroid of each unit vector."""
    centroids = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        owner = (points @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, points)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 0
        centroids[moved] = sums[moved] / norms[moved, None]
    return centroids, (points @ centroids.T).argmax(axis=1)


class Tree:
    """``children[node]`` are node numbers, ``centroids[node]`` their unit centroids; a node without children is a leaf."""

    def __init__(self) -> None:
        self.children: list[list[int]] = [[]]
        self.centroids: list[np.ndarray | None] = [None]

    def grow(self, node: int, points: np.ndarray, rng: np.random.Generator) -> None:
        if len(points) <= LEAF_ROWS or np.ptp(points, axis=0).max() < 1e-12:
            return
        centroids, owner = k_means(points, min(CHILDREN, len(points)), rng)
        used = np.unique(owner)
        if len(used) < 2:
            return
        self.centroids[node] = centroids[used]
        for u in used:
            self.children.append([])
            self.centroids.append(None)
            self.children[node].append(len(self.children) - 1)
        for u, child in zip(used, self.children[node]):
            self.grow(child, points[owner == u], rng)

    def assign(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector."""
        leaf = np.zeros(len(points), np.int64)
        pending = [(0, np.arange(len(points)))]
        while pending:
            node, rows = pending.pop()
            leaf[rows] = node
            if self.children[node] and len(rows):
                owner = (points[rows] @ self.centroids[node].T).argmax(axis=1)
                pending += [(child, rows[owner == i]) for i, child in enumerate(self.children[node])]
        return leaf

    def cells(self) -> dict[int, int]:
        """The child of the root that each leaf is under."""
        found = {}
        for cell in self.children[0] or [0]:
            pending = [cell]
            while pending:
                node = pending.pop()
                pending += self.children[node]
                if not self.children[node]:
                    found[node] = cell
        return found

    def visits(self, point: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which best-bin-first search reaches them."""
        heap = [(-1.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if not self.children[node]:
                yield node
                continue
            for child, value in zip(self.children[node], self.centroids[node] @ point):
                heapq.heappush(heap, (-float(value), child))


def units(points: np.ndarray) -> np.ndarray:
    """Vectors at length one; scaled by the largest component first, so that no square overflows."""
    scaled = points / np.abs(points).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Cosine of one vector and each of several, always computed in the same order of operations."""
    query, points = query / np.abs(query).max(), points / np.abs(points).max(axis=1, keepdims=True)
    return (points * query).sum(axis=1) / (np.sqrt((points * points).sum(axis=1)) * np.sqrt((query * query).sum()))


def nearest(queries: np.ndarray, points: np.ndarray, point_ids: np.ndarray, k: int, leaves: np.ndarray | None = None, visited: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its place, and the ids and scores of its ``k`` nearest points, nearest first, ties to the smaller id.

    With the points' ``leaves`` a query meets only the points of those it has ``visited``.
    """
    if leaves is None:
        leaves, visited = np.zeros(len(points), np.int64), [[0]] * len(queries)
    order = np.argsort(leaves, kind="stable")
    points, point_ids = points[order], point_ids[order]
    names, starts = np.unique(leaves[order], return_index=True)
    stops = np.append(starts[1:], len(points))
    unit_points = units(points)
    for low in range(0, len(queries), 256):
        block = units(queries[low : low + 256])
        comes = np.array([np.isin(names, list(v)) for v in visited[low : low + 256]])
        rough = np.full((len(block), len(points)), -np.inf)
        for leaf, (start, stop) in enumerate(zip(starts, stops)):
            who = np.flatnonzero(comes[:, leaf])
            rough[who, start:stop] = block[who] @ unit_points[start:stop].T
        for i, row in enumerate(rough):
            last = np.partition(row, -k)[-k] if len(row) > k else -np.inf
            close = np.flatnonzero((row >= last - CLOSE) & (row > -np.inf))
            score = cosine(queries[low + i], points[close])
            order = np.lexsort((point_ids[close], -score))[:k]
            yield low + i, point_ids[close][order], score[order]


def _found(group: pd.DataFrame, points: np.ndarray, point_ids: np.ndarray, k: int, leaves: np.ndarray | None = None) -> pd.DataFrame:
    keys, ids, scores = [], [], []
    visited = None if leaves is None else list(group["leaves"])
    for i, found, score in nearest(matrix(group["vec"]), points, point_ids, k, leaves, visited):
        keys += [group["query"].iloc[i]] * len(found)
        ids.append(found)
        scores.append(score)
    return pd.DataFrame({"query": keys, "vec_id": np.concatenate(ids or [np.empty(0, np.int64)]), "score": np.concatenate(scores or [np.empty(0)])})


FOUND = "query bigint, vec_id bigint, score double"


def _ranked(found: DataFrame, key: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def fit(rows: DataFrame) -> dict[int, Tree]:
    """A tree for each length of vector, from one bounded sample of ``vec_id, vec, dim``; a length the sample misses has one leaf."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree()
        tree.grow(0, units(matrix(group.sort_values("vec_id")["vec"])), np.random.default_rng(8))
        flat = [[] if c is None else [list(map(float, x)) for x in c] for c in tree.centroids]
        return pd.DataFrame({"dim": int(group["dim"].iloc[0]), "node": range(len(flat)), "children": tree.children, "centroids": flat})

    # Nodes are fewer than sampled rows.
    grown = sample.groupBy("dim").applyInPandas(grow, "dim int, node int, children array<int>, centroids array<array<double>>")
    trees: dict[int, Tree] = {}
    for row in sorted(grown.collect(), key=lambda r: (r.dim, r.node)):
        tree = trees.setdefault(row.dim, Tree())
        if row.node == 0:
            tree.children, tree.centroids = [], []
        tree.children.append(list(row.children))
        tree.centroids.append(np.array(row.centroids) if row.centroids else None)
    for row in rows.select("dim").distinct().collect():
        trees.setdefault(row.dim, Tree())
    return trees


def search(df: DataFrame, is_query: Column, k: int = 5, recall: float = RECALL, vec_id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query row, by cosine.

    A query's own row, and any row with its id, is no candidate. Fewer than
    ``k`` other rows are all returned; ties go to the smaller id. Rows without an
    id and vectors that are null, empty, zero or hold null or non-finite
    components take no part; vectors of different length never meet. Repeated
    rows count once, and so do rows that share an id and a vector.
    """
    good = finite_vectors(df, vec_id, vector)
    asked = finite_vectors(df.filter(is_query), vec_id, vector).select("vec_id").distinct()
    good = good.filter(F.exists("vec", lambda x: x != 0)).distinct()
    # A 128-bit key stands for the vector's exact content.
    keyed = checkpoint_once(good.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(7), "vec")))
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    rows = checkpoint_once(keyed.withColumn("place", place).filter(F.col("place") <= k + 1))
    alike = keyed.select("vec_id", "h1", "h2").join(asked, "vec_id")
    first = rows.filter("place = 1").select("h1", "h2", F.col("vec_id").alias("query"), "vec", "dim")
    queries = checkpoint_once(first.join(alike.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi"))

    context = df.sparkSession.sparkContext
    trees = context.broadcast(fit(rows))
    cells = context.broadcast({dim: tree.cells() for dim, tree in trees.value.items()})
    visits = context.broadcast(_calibrated(queries, rows, trees.value, k, recall))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, group in batch.groupby("dim"):
                leaf = trees.value[dim].assign(units(matrix(group["vec"])))
                yield group.assign(leaf=leaf, cell=[cells.value[dim][i] for i in leaf])

    placed = rows.select("vec_id", "vec", "dim").mapInPandas(assign, "vec_id bigint, vec array<double>, dim int, leaf bigint, cell bigint")
    placed = checkpoint_once(placed)
    # One number per leaf.
    sizes = {(r.dim, r.leaf): r["count"] for r in placed.groupBy("dim", "leaf").count().collect()}
    filled = context.broadcast(sizes)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for query, vec, dim in zip(batch["query"], batch["vec"], batch["dim"]):
                seen, held, by_cell = 0, 0, {}
                for leaf in trees.value[dim].visits(units(np.asarray(vec)[None, :])[0]):
                    if seen >= visits.value[dim] and held > k:
                        break
                    seen, held = seen + 1, held + filled.value.get((dim, leaf), 0)
                    if (dim, leaf) in filled.value:
                        by_cell.setdefault(cells.value[dim][leaf], []).append(leaf)
                out += [(query, vec, dim, cell, leaves) for cell, leaves in by_cell.items()]
            yield pd.DataFrame(out, columns=["query", "vec", "dim", "cell", "leaves"])

    asked_of = "query bigint, vec array<double>, dim int, cell bigint, leaves array<bigint>"
    visiting = checkpoint_once(queries.select("query", "vec", "dim").mapInPandas(visit, asked_of))
    # Two numbers per cell.
    spark = df.sparkSession
    rows_in = {(r.dim, r.cell): r["count"] for r in placed.groupBy("dim", "cell").count().collect()}
    visitors = {(r.dim, r.cell): r["count"] for r in visiting.groupBy("dim", "cell").count().collect()}
    blocks = [(dim, cell, blocks_for(n, block_rows), blocks_for(visitors.get((dim, cell), 0), block_rows)) for (dim, cell), n in rows_in.items()]
    blocks = F.broadcast(spark.createDataFrame(blocks, "dim int, cell bigint, row_blocks bigint, query_blocks bigint"))

    def grid(frame: DataFrame, key: str, own: str, other: str) -> DataFrame:
        frame = frame.join(blocks, ["dim", "cell"]).withColumn(own[:-1], F.pmod(F.xxhash64(key), F.col(own)))
        return frame.withColumn(other[:-1], F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))).drop(own, other)

    keys = ["dim", "cell", "row_block", "query_block"]

    def compare(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        if not len(one) or not len(other):
            return pd.DataFrame({"query": [], "vec_id": [], "score": []})
        return _found(one, matrix(other["vec"]), other["vec_id"].to_numpy(), k + 1, other["leaf"].to_numpy())

    asking = grid(visiting, "query", "query_blocks", "row_blocks").groupBy(keys)
    found = asking.cogroup(grid(placed, "vec_id", "row_blocks", "query_blocks").groupBy(keys)).applyInPandas(compare, FOUND)
    best = checkpoint_once(_ranked(found, "query", k + 1).drop("rank").join(queries.select("query", "h1", "h2"), "query"))
    own = alike.withColumnRenamed("vec_id", "query_id").join(best, ["h1", "h2"]).filter("query_id <> vec_id")
    return _ranked(own, "query_id", k).select("query_id", "rank", "vec_id", "score")


def exact(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``query, vec_id, score, rank``: exact neighbours of a bounded set of queries, by one pass over all rows."""
    asked: dict[int, pd.DataFrame] = {}
    for row in queries.collect():
        asked.setdefault(row.dim, []).append((row["query"], row.vec))
    sent = queries.sparkSession.sparkContext.broadcast({d: pd.DataFrame(found, columns=["query", "vec"]) for d, found in asked.items()})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, group in batch.groupby("dim"):
                if dim in sent.value:
                    yield _found(sent.value[dim], matrix(group["vec"]), group["vec_id"].to_numpy(), k)

    return _ranked(rows.select("vec_id", "vec", "dim").mapInPandas(scan, FOUND), "query", k)


def _calibrated(queries: DataFrame, rows: DataFrame, trees: dict[int, Tree], k: int, recall: float) -> dict[int, int]:
    """Leaves to visit in the tree of each vector length, at least so many that ``recall`` is reached on the calibration queries."""
    sample = checkpoint_once(queries.orderBy(F.xxhash64("query"), "query").limit(CALIBRATION_QUERIES))
    truth = exact(sample, rows, k + 1).join(rows.select("vec_id", "vec"), "vec_id")
    vectors = {r["query"]: (r.dim, np.array(r.vec)) for r in sample.collect()}
    needed: dict[int, list[int]] = {dim: [] for dim in trees}
    # At most k + 1 rows for each calibration query.
    wanted: dict[int, list] = {}
    for row in truth.select("query", "vec_id", "vec").collect():
        if row["query"] != row.vec_id:
            wanted.setdefault(row["query"], []).append(row.vec)
    for query, found in wanted.items():
        dim, vec = vectors[query]
        order = {leaf: i for i, leaf in enumerate(trees[dim].visits(units(vec[None, :])[0]), 1)}
        needed[dim] += [order[leaf] for leaf in trees[dim].assign(units(np.array(found)))]
    widest = {dim: sum(not c for c in tree.children) for dim, tree in trees.items()}
    return {dim: sorted(n)[min(len(n) - 1, int(np.ceil(recall * len(n))))] if (n := needed[dim]) else widest[dim] for dim in trees}

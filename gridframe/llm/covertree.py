"""Exact top-k inner products by a dual-tree search over cover trees.

The rows are cut into blocks of bounded size, each row in one of them, and every
block gets one cover tree: the centres of a node's children are picked farthest
first, so they lie apart by at least the covering radius that is left. All
queries visit every block in batches, and a batch gets a cover tree as well. With
centres a, b and covering radii r, s no inner product exceeds
a.b + r|b| + s|a| + rs. A pair of nodes whose bound is below the worst k-th score
of the query node is dropped, else the node of larger radius is opened. What is
left for a leaf of queries is bounded for each query alone (r = 0), and the
remaining points are compared outright, those of the highest bounds first. Each
query enters with the k-th score it has within one bounded sample of the data,
which no result can fall below.

Scores are whole numbers and exact at any magnitude. Single precision holds them
where vectors are short enough; for longer ones it tells which pairs may reach
the k-th score, and only their scores are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.vectors import blocks_for
from gridframe.operators.extent import checkpoint_once

# Rows of one block at most, and bytes of its vectors in a worker on average;
# blocks may be smaller, down to LEAST_ROWS, where cores would have none.
BLOCK_ROWS, BLOCK_BYTES, LEAST_ROWS = 262_144, 128 * 1024 * 1024, 8_192
# Queries of one batch; rows and bytes of the sample that gives the first bounds.
QUERY_ROWS = 8_192
SAMPLE_ROWS, SAMPLE_BYTES = 131_072, 16 * 1024 * 1024
# Points of a leaf, and children of a node, of the trees of rows and of queries.
LEAF, CHILDREN = 256, 32
QUERY_LEAF, QUERY_CHILDREN = 4_096, 4
# Points compared at a time, and those of the highest bounds compared first.
TILE, FIRST = 512, 4_096
# Whole numbers below these are exact in single and double precision; products
# of vectors shorter than LONG are far from the end of single precision.
EXACT_SINGLE, EXACT = 2.0**24, 2.0**52
LONG = 2.0**60
LONGEST = 2**63 - 1


@dataclass
class Node:
    """Points ``start`` to ``stop`` of the reordered block, within ``radius`` of ``centre``."""

    start: int
    stop: int
    centre: np.ndarray
    radius: float
    children: list[Node]


def cover_tree(points: np.ndarray) -> tuple[Node | None, np.ndarray]:
    """Root and the order in which every node's points are consecutive."""
    order = np.arange(len(points))
    return grow(points.copy(), order, LEAF, CHILDREN) if len(points) else None, order


def grow(points: np.ndarray, order: np.ndarray, leaf: int, most: int) -> Node:
    """Root of the cover tree; ``points`` and ``order`` are put in its order.

    A child that would keep over half of its parent's points is cut in two by
    the distance from its centre, so the depth is bounded for any points.
    """
    single = points.dtype == np.float32
    with np.errstate(over="ignore"):
        squares = np.einsum("ij,ij->i", points, points)
    longest = float(squares.max())
    # Squared distances of single precision are off by no more than this, vectors by no more than `off`.
    blur, off = (0.0, 0.0) if not single or 4 * longest < EXACT_SINGLE else ((points.shape[1] + 8) * 2.0**-20 * longest, 2.0**-22 * longest**0.5)

    def squared(start: int, stop: int, centre: np.ndarray) -> np.ndarray:
        own = points[start:stop]
        if single:
            return np.maximum(squares[start:stop] + centre @ centre - 2 * (own @ centre), 0)
        return ((own - centre) ** 2).sum(axis=1)

    def build(start: int, stop: int, centre: np.ndarray, nearest: np.ndarray) -> Node:
        far = float(nearest.max())
        node = Node(start, stop, centre, (far + blur) ** 0.5 * (1 + 1e-9) + off, [])
        if stop - start <= leaf or not blur < far < np.inf:
            return node
        nearest, owner, centres = nearest.copy(), np.zeros(stop - start, np.int32), [centre]
        while len(centres) < most and nearest[at := int(nearest.argmax())] > blur:
            centres.append(points[start + at].copy())
            away = squared(start, stop, centres[-1])
            owner[away < nearest] = len(centres) - 1
            np.minimum(nearest, away, out=nearest)

        def arrange(low: int, high: int, sorting: np.ndarray) -> None:
            for values in (nearest, owner):
                values[low:high] = values[low:high][sorting]
            for values in (points, order, squares):
                values[start + low : start + high] = values[start + low : start + high][sorting]

        arrange(0, stop - start, np.argsort(owner, kind="stable"))
        edges = np.flatnonzero(np.diff(owner, prepend=-1, append=len(centres)))
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
            cuts = [low, high]
            if high - low > (stop - start) // 2:
                arrange(low, high, np.argsort(nearest[low:high], kind="stable"))
                cuts = [low, (low + high) // 2, high]
            for a, b in zip(cuts[:-1], cuts[1:]):
                node.children.append(build(start + a, start + b, centres[owner[a]], nearest[a:b]))
        return node

    with np.errstate(over="ignore", invalid="ignore"):
        middle = points[int(squared(0, len(points), points.mean(axis=0, dtype=np.float64).astype(points.dtype)).argmin())].copy()
        return build(0, len(points), middle, squared(0, len(points), middle))


def at_most(whole: int) -> float:
    """The largest double that does not exceed a whole number."""
    try:
        near = float(whole)
    except OverflowError:
        return float(np.finfo(float).max) if whole > 0 else -np.inf
    return near if near <= whole else float(np.nextafter(near, -np.inf))


def exact_products(left: np.ndarray, right: np.ndarray, most: float) -> np.ndarray:
    """Products of the rows of two tables of whole numbers, in Python's integers where doubles could round (``most`` is no less than any)."""
    if most < EXACT:
        return np.einsum("ij,ij->i", left.astype(np.float64), right.astype(np.float64))
    out = np.empty(len(left), dtype=object)
    out[:] = [sum(int(x) * int(y) for x, y in zip(a, b)) for a, b in zip(left.tolist(), right.tolist())]
    return out


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which are among the ``k`` best of their query, by query and from the best down, and their places."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -scores[i], ids[i])), dtype=np.int64)
    else:
        order = np.lexsort((ids, -scores, query))
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return order[place < k], place[place < k]


def length(whole: np.ndarray) -> float:
    """No less than the length of any row."""
    if not whole.size:
        return 0.0
    with np.errstate(over="ignore"):
        kind = np.float32 if whole.dtype == np.int16 else np.float64
        most = max(float(np.einsum("ij,ij->i", part, part).max()) for part in (whole[i : i + 8_192].astype(kind) for i in range(0, len(whole), 8_192)))
    return most**0.5 * (1 + (whole.shape[1] + 8) * 2.0**-22)


class Index:
    """One block of vectors of whole numbers in the order of its cover tree, whose nodes are arrays."""

    def __init__(self, whole: np.ndarray, ids: np.ndarray, double: bool = False) -> None:
        self.length = length(whole)
        self.double = double or not self.length < LONG
        # Points of a leaf stay in the order of their ids, as sorting is stable.
        order = np.argsort(ids, kind="stable")
        self.points = whole[order].astype(np.float64 if self.double else np.float32)
        nodes = [grow(self.points, order, LEAF, CHILDREN)]
        self.whole, self.ids = whole[order], ids[order]
        first, last = [], []
        for node in nodes:
            first.append(len(nodes))
            nodes.extend(node.children)
            last.append(len(nodes))
        self.first, self.last = np.array(first), np.array(last)
        self.start, self.stop = np.array([n.start for n in nodes]), np.array([n.stop for n in nodes])
        self.centre, self.radius = np.array([n.centre for n in nodes]).reshape(len(nodes), whole.shape[1]), np.array([n.radius for n in nodes])
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((self.centre.astype(np.float64) ** 2).sum(axis=1))
        # Relative error of products in the precision of the points.
        self.error = (whole.shape[1] + 8) * (2.0**-50 if self.double else 2.0**-22)

    def search(self, whole: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, ids and scores of the ``k`` best points of each query that reach its floor, those at the floor up to its id."""
        longest = length(whole)
        if not self.double and not longest < LONG:
            return Index(self.whole, self.ids, double=True).search(whole, query_ids, floors, floor_ids, k)
        with np.errstate(over="ignore", invalid="ignore"):
            return _Search(self, whole, longest, query_ids, floors, floor_ids, k).found()


class _Search:
    """One batch of queries against one block."""

    def __init__(self, index: Index, whole: np.ndarray, longest: float, query_ids: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray, k: int) -> None:
        self.index, self.k = index, k
        self.queries, order = whole.astype(index.points.dtype), np.arange(len(whole))
        self.root = grow(self.queries, order, QUERY_LEAF, QUERY_CHILDREN)
        self.whole, self.ids = whole[order], query_ids[order]
        # The k-th score so far, and the largest id that a result with just this score may have.
        self.worst, self.worst_id = floors[order].astype(np.float64), floor_ids[order].astype(np.int64)
        self.norm = np.sqrt((self.queries.astype(np.float64) ** 2).sum(axis=1))
        self.most = longest * index.length
        self.exact = not index.double and self.most < EXACT_SINGLE
        none = np.empty(0, np.int64)
        self.nothing = (none, none, np.empty(0, np.float64 if self.most < EXACT else object))
        # Of one leaf of queries, as places of queries, ids and scores; then those of all leaves.
        self.best, self.pending, self.waiting, self.most_waiting = self.nothing, [], 0, 0
        self.all = [self.nothing]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.visit(self.root, np.zeros(1, np.int64))
        query, ids, scores = (np.concatenate(part) for part in zip(*self.all))
        return self.ids[query], ids, scores

    def reachable(self, a: Node, nodes: np.ndarray) -> np.ndarray:
        """The nodes of the index whose bound reaches the worst k-th score of a node of queries."""
        index, own = self.index, float(np.sqrt((a.centre.astype(np.float64) ** 2).sum()))
        norm, radius = index.norm[nodes], index.radius[nodes]
        limit = index.centre[nodes] @ a.centre + a.radius * norm + radius * own + a.radius * radius
        limit += (index.error + 1e-9) * (own + a.radius) * (norm + radius)
        return nodes[~(limit < self.worst[a.start : a.stop].min())]

    def visit(self, a: Node, nodes: np.ndarray) -> None:
        index = self.index
        nodes = self.reachable(a, nodes)
        while True:
            inner = index.first[nodes] < index.last[nodes]
            opened = inner & ~(index.radius[nodes] < a.radius) if a.children else inner
            if not opened.any():
                break
            children = [np.arange(index.first[n], index.last[n]) for n in nodes[opened]]
            nodes = np.concatenate([nodes[~opened], self.reachable(a, np.concatenate(children))])
        if not len(nodes):
            return
        if not a.children:
            self.compare(a, nodes)
        for child in a.children:
            self.visit(child, nodes)

    def compare(self, a: Node, leaves: np.ndarray) -> None:
        index, queries, norm = self.index, self.queries[a.start : a.stop], self.norm[a.start : a.stop]
        leaves = leaves[np.argsort(index.start[leaves])]
        # The bound of each leaf and query as one product; rounding errors are allowed for.
        radius = index.radius[leaves]
        radius = radius + 2 * (index.error + 1e-9) * (index.norm[leaves] + radius)
        across = np.ascontiguousarray(queries.T)
        limits = np.column_stack([index.centre[leaves], radius]).astype(across.dtype) @ np.vstack([across, norm]).astype(across.dtype)
        highest = limits.max(axis=1)
        ranked = np.argsort(-highest, kind="stable")
        early = ranked[: 1 + np.searchsorted(np.cumsum((index.stop - index.start)[leaves[ranked]]), FIRST)]
        rest = np.ones(len(leaves), bool)
        rest[early] = False
        room = np.empty(TILE * len(queries), queries.dtype)
        self.most_waiting = 2 * self.k * len(queries) + TILE
        for some in (np.sort(early), np.flatnonzero(rest)):
            some = some[~(highest[some] < self.worst[a.start : a.stop].min())]
            starts, stops = index.start[leaves[some]].tolist(), index.stop[leaves[some]].tolist()
            low = 0
            for high in range(1, len(some) + 1):
                if high < len(some) and starts[high] == stops[high - 1] and stops[high] - starts[low] <= TILE:
                    continue
                picked = ~(limits[some[low:high]].max(axis=0) < self.worst[a.start : a.stop])
                if picked.any():
                    at = np.arange(a.start, a.stop)[picked]
                    columns = across if picked.all() else np.ascontiguousarray(across[:, picked])
                    for start in range(starts[low], stops[high - 1], TILE):
                        self.tile(at, columns, start, min(start + TILE, stops[high - 1]), room)
                low = high
            self.settle()
        self.all.append(self.best)
        self.best = self.nothing

    def tile(self, at: np.ndarray, columns: np.ndarray, start: int, stop: int, room: np.ndarray) -> None:
        """Compare the queries at these places with points ``start`` to ``stop``."""
        index = self.index
        scores = room[: (stop - start) * len(at)].reshape(stop - start, len(at))
        np.matmul(index.points[start:stop], columns, out=scores)
        least = self.worst[at] if self.exact else self.worst[at] - index.error * index.length * self.norm[at]
        cut = least.astype(scores.dtype)
        cut = np.where(cut > least, np.nextafter(cut, cut.dtype.type(-np.inf)), cut)
        if self.exact:
            cut = np.where(self.worst_id[at] < index.ids[start:stop].min(), np.nextafter(cut, cut.dtype.type(np.inf)), cut)
        some = np.flatnonzero(~(scores.max(axis=0) < cut))
        if not len(some):
            return
        reached = np.take(scores, some, axis=1)
        point, query = np.nonzero(~(reached < cut[some]))
        value, point, query = reached[point, query], point + start, at[some[query]]
        other = index.ids[point] != self.ids[query]
        value, point, query = value[other], point[other], query[other]
        if not self.exact:
            value = exact_products(self.whole[query], index.whole[point], self.most)
        if self.most < EXACT:
            good = (value > self.worst[query]) | (value == self.worst[query]) & (index.ids[point] <= self.worst_id[query])
            value, point, query = value[good], point[good], query[good]
        self.pending.append((query, index.ids[point], value.astype(self.nothing[2].dtype)))
        self.waiting += len(query)
        if self.waiting > self.most_waiting:
            self.settle()

    def settle(self) -> None:
        """Keep the best of what waits, and raise the scores that others must reach."""
        if not self.waiting:
            return
        query, ids, scores = (np.concatenate(part) for part in zip(self.best, *self.pending))
        kept, place = best_of(query, ids, scores, self.k)
        self.best = query[kept], ids[kept], scores[kept]
        self.pending, self.waiting = [], 0
        last = kept[place == self.k - 1]
        at = query[last]
        if scores.dtype == object:
            self.worst[at] = np.maximum(self.worst[at], np.array([at_most(x) for x in scores[last]], np.float64))
            return
        # Higher, as anything worse than the floor was left out, or at the same score with no larger id.
        self.worst[at], self.worst_id[at] = scores[last], ids[last]


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, points: np.ndarray, point_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best points of each query that reach its floor: ``query_id, vec_id, score``."""
    if not len(queries) or not len(points):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    query, ids, scores = Index(points, point_ids).search(queries, query_ids, floors, np.full(len(queries), LONGEST), k)
    return pd.DataFrame({"query_id": query, "vec_id": ids, "score": as_longs(scores)})


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Whole numbers, each as the nearest long."""
    if scores.dtype == object:
        return np.array([max(-LONGEST - 1, min(LONGEST, s)) for s in scores], np.int64)
    return scores.astype(np.int64)


def packed(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Rows with an id and a vector of finite numbers that stay finite when scaled, their whole components as bytes: two each where they fit, else eight."""
    for batch in batches:
        lists, ids = batch.column("vec"), batch.column("vec_id")
        with np.errstate(over="ignore", invalid="ignore"):
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, odd = np.cumsum(sizes), np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        good = (odd[ends] == odd[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
        flat, sizes = flat[np.repeat(good, sizes)], sizes[good]
        kind = np.dtype("<i2") if np.abs(flat).max(initial=0) < 2**15 else np.dtype("<f8")
        offsets = np.concatenate([[0], np.cumsum(sizes * kind.itemsize)]).astype(np.int32)
        vectors = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(flat.astype(kind).tobytes())])
        kept = pa.array(good)
        columns = [ids.filter(kept), pa.array(sizes.astype(np.int32)), vectors, batch.column("chosen").filter(kept)]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "vec", "chosen"])


def unpacked(vectors: list[bytes], dim: int) -> np.ndarray:
    """Whole numbers of packed vectors of one length, a row each."""
    if all(len(v) == 2 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), dim)
    return np.array([np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8") for v in vectors], np.float64).reshape(len(vectors), dim)


def top_k(df: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, vec_id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query row with all other rows.

    Components x count as floor(``scale`` * x). Ties go to the smaller id; with
    fewer than ``k`` others all are returned. Rows with the query's id are its
    own. Vectors that are null, hold null or non-finite components or overflow
    when scaled take no part, nor do rows without an id; vectors of different
    length never meet. Repeated query rows give one result, repeated candidate
    rows count each. A score beyond a long is returned as the nearest long.
    """
    given = df.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("chosen"),
    )
    # Stored once and small: later plans read rows of some bytes a component.
    rows = checkpoint_once(given.mapInArrow(lambda batches: packed(batches, scale), "vec_id bigint, dim int, vec binary, chosen boolean"))
    n_rows, n_numbers, n_bytes = (x or 0 for x in rows.agg(F.count("*"), F.sum(F.col("dim").cast("bigint")), F.sum(F.octet_length("vec").cast("bigint"))).first())

    # The sample is bounded, whatever the table's size.
    share = min(SAMPLE_ROWS / max(1, n_rows), SAMPLE_BYTES / max(1, n_bytes))
    sample = rows.filter(F.rand(7) < share).select("vec_id", "dim", "vec").toArrow().to_pydict()
    by_dim: dict[int, list[int]] = {}
    for i, dim in enumerate(sample["dim"]):
        by_dim.setdefault(dim, []).append(i)
    sent = df.sparkSession.sparkContext.broadcast({d: (unpacked([sample["vec"][i] for i in at], d), np.array([sample["vec_id"][i] for i in at], np.int64)) for d, at in by_dim.items()})

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes: dict[int, Index] = {}
        for batch in together(batches, QUERY_ROWS):
            dims, ids, vectors = batch.column("dim").to_numpy(), batch.column("vec_id").to_numpy(), batch.column("vec").to_pylist()
            floor, floor_id = np.full(len(ids), -np.inf), np.full(len(ids), LONGEST)
            for dim in np.unique(dims).tolist():
                if dim not in sent.value or len(sent.value[dim][1]) < k:
                    continue
                if dim not in indexes:
                    indexes[dim] = Index(*sent.value[dim])
                at = np.flatnonzero(dims == dim)
                query, found, scores = indexes[dim].search(unpacked([vectors[i] for i in at], dim), ids[at], floor[at], floor_id[at], k)
                kept, place = best_of(query, found, scores, k)
                last = kept[place == k - 1]
                full = at[np.argsort(ids[at])][np.searchsorted(np.sort(ids[at]), query[last])]
                floor[full] = [at_most(int(x)) for x in scores[last]]
                # A score that was rounded down has no id beside it.
                floor_id[full] = [i if f == int(x) else LONGEST for i, f, x in zip(found[last].tolist(), floor[full].tolist(), scores[last])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor), pa.array(floor_id)], names=[*batch.schema.names, "floor", "floor_id"])

    queries = rows.filter("chosen").select("vec_id", "dim", "vec").dropDuplicates(["vec_id"])
    queries = checkpoint_once(queries.mapInArrow(floors, "vec_id bigint, dim int, vec binary, floor double, floor_id bigint"))

    idle = min(3 * df.sparkSession.sparkContext.defaultParallelism, blocks_for(n_rows, LEAST_ROWS))
    blocks = max(blocks_for(n_rows, block_rows), blocks_for(4 * n_numbers + 2 * n_bytes, BLOCK_BYTES), idle)
    # Rows are dealt out evenly, whatever their ids; a block's rows come before the queries that visit it.
    own = F.pmod(F.monotonically_increasing_id(), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    left = rows.select(own.alias("block"), F.lit(0).alias("side"), "vec_id", "dim", "vec", F.lit(None).cast("double").alias("floor"), F.lit(None).cast("bigint").alias("floor_id"))
    right = queries.select(every.alias("block"), F.lit(1).alias("side"), "vec_id", "dim", "vec", "floor", "floor_id")
    both = left.unionByName(right)
    both = both.withColumn("place", (F.col("dim").cast("bigint") * blocks + F.col("block")) * 2 + F.col("side"))
    both = both.repartitionById(blocks, F.pmod(F.col("block") + F.col("dim"), F.lit(blocks)).cast("int")).drop("block", "side").sortWithinPartitions("place")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, vectors, ids, index = -1, [], [], None
        waiting: list[tuple[np.ndarray, ...]] = []

        def answer() -> pa.RecordBatch:
            nonlocal index, vectors, ids
            if index is None:
                whole, own_ids, vectors, ids = np.concatenate(vectors), np.concatenate(ids), [], []
                index = Index(whole, own_ids)
            query, found, scores = index.search(*(np.concatenate(part) for part in zip(*waiting)), k)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(found), pa.array(as_longs(scores))], names=["query_id", "vec_id", "score"])

        for batch in batches:
            place = batch.column("place").to_numpy()
            edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part = batch.slice(low, high - low)
                if group != place[low] // 2:
                    if waiting:
                        yield answer()
                    group, vectors, ids, index = place[low] // 2, [], [], None
                whole, part_ids = unpacked(part.column("vec").to_pylist(), part.column("dim")[0].as_py()), part.column("vec_id").to_numpy()
                if place[low] % 2 == 0:
                    vectors.append(whole)
                    ids.append(part_ids)
                elif vectors or index:
                    waiting.append((whole, part_ids, part.column("floor").to_numpy(), part.column("floor_id").to_numpy()))
                    if sum(len(x[1]) for x in waiting) >= QUERY_ROWS:
                        yield answer()
        if waiting:
            yield answer()

    found = both.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least this many rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)

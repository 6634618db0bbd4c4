import math
import time

import numpy as np
import pytest

from gridframe.llm import covertree, queries


def brute(rows, is_query, k, scale=1024):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(set(out))


def test_cover_tree_covers():
    points = np.random.default_rng(2).integers(-50, 50, (700, 5)).astype(float)
    root, order = covertree.cover_tree(points)
    assert sorted(order) == list(range(700))

    def walk(node):
        inside = points[order[node.start : node.stop]]
        assert np.sqrt(((inside - node.centre) ** 2).sum(axis=1)).max() <= node.radius
        if node.children:
            assert [c.start for c in node.children] == [node.start] + [c.stop for c in node.children[:-1]]
            assert node.children[-1].stop == node.stop
        for child in node.children:
            walk(child)

    walk(root)


@pytest.mark.parametrize("block_rows", [8192, 60])
def test_same_as_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 6))
    rows = [(i, [float(x) for x in centres[i % 9] + 0.2 * rng.normal(size=6)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 440)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = covertree.top_k(df, df.vec_id % 10 == 0, k=7, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0, 7)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0]), (6, []), (7, [-0.5, 0.25]), (None, [1.0, 1.0]), (8, [1e9, 3e12]), (9, [-1e9, 2e12])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as score", "'y' as dim")
    got = covertree.top_k(df, df.vec_id >= 0, k=3)
    want = [(q, r, i, min(max(s, -(2**63)), 2**63 - 1)) for q, r, i, s in brute(rows, lambda i: i >= 0, 3)]
    assert sorted(map(tuple, got.collect())) == want
    assert covertree.top_k(df.limit(0), df.vec_id >= 0).count() == 0


def test_scores_that_a_double_rounds_up():
    assert [covertree.at_most(x) for x in (2**53 + 3, -(2**53) - 3, 10**400, -(10**400), 7)] == [2**53 + 2, -(2**53) - 4, np.finfo(float).max, -math.inf, 7]
    score = 2**53 + 3
    factor = next(d for d in range(3, 10**6, 2) if score % d == 0)
    query, point = np.array([[float(factor)]]), np.array([[float(score // factor)]])
    points = np.repeat(point, 200, axis=0)
    for floor in (-np.inf, covertree.at_most(score)):
        got = covertree.dual_tree(query, np.array([-1]), np.array([floor]), points, np.arange(200)[::-1].copy(), 2)
        assert list(got["vec_id"]) == [0, 1] and set(got["score"]) == {score}


def test_floor_is_no_higher_than_the_score(spark):
    factor = next(d for d in range(3, 10**6, 2) if (2**53 + 3) % d == 0)
    rows = [(0, [float(factor)])] + [(i, [float((2**53 + 3) // factor)]) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, covertree.top_k(df, df.vec_id == 0, k=3, scale=1.0).collect()))
    assert got == [(0, 1, 1, 2**53 + 3), (0, 2, 2, 2**53 + 3), (0, 3, 3, 2**53 + 3)]


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op3_cover_tree(spark, path).collect())) == brute(rows, lambda i: i % 100 == 0, 10)


def vectors(rng, rows, dim, length=1024):
    drawn = rng.normal(size=(rows, dim))
    return np.floor(length * drawn / np.sqrt((drawn**2).sum(axis=1, keepdims=True)))


def test_pairs_that_no_bound_rules_out_are_compared_together():
    rng = np.random.default_rng(7)
    points, asked = vectors(rng, 20_000, 64), vectors(rng, 400, 64)
    began = time.process_time()
    got = covertree.dual_tree(asked, -1 - np.arange(400), np.full(400, -np.inf), points, np.arange(20_000), 10)
    assert time.process_time() - began < 6
    scores = asked @ points.T
    for q in range(400):
        best = np.lexsort((np.arange(20_000), -scores[q]))[:10]
        own = got[got["query_id"] == -1 - q]
        assert list(zip(own["vec_id"], own["score"])) == [(i, scores[q, i]) for i in best]


@pytest.mark.parametrize("length", [3, 1024, 40_000, 2.0**22, 2.0**45, 2.0**80])
def test_scores_of_any_length(length):
    rng = np.random.default_rng(8)
    points, asked = vectors(rng, 1_500, 5, length), vectors(rng, 30, 5, length)
    points[500:600] = points[0]
    got = covertree.dual_tree(asked, np.arange(30), np.full(30, -np.inf), points, np.arange(1_500)[::-1].copy(), 4)
    for q in range(30):
        scored = sorted((-sum(int(x) * int(y) for x, y in zip(asked[q], points[1_499 - i])), i) for i in range(1_500) if i != q)[:4]
        own = got[got["query_id"] == q]
        assert list(zip(own["vec_id"], own["score"])) == [(i, max(-(2**63), min(2**63 - 1, -s))) for s, i in scored]


def test_depth_is_bounded():
    points = np.concatenate([2.0 ** np.arange(900), -(2.0 ** np.arange(900)), np.arange(4_000)])[:, None]
    root, order = covertree.cover_tree(points)
    depth, level = 0, [root]
    while level:
        depth, level = depth + 1, [c for node in level for c in node.children]
    assert sorted(order) == list(range(5_800)) and depth < 16


def test_blocks_share_repeated_rows_ties_and_lengths(spark):
    rng = np.random.default_rng(9)
    rows = [(i % 150, [float(x) for x in rng.integers(-3, 4, 2 + i % 3) / 4]) for i in range(300)]
    rows = [(i, rows[i % 150][1]) for i, _ in rows] + [(900 + i, [0.5, 40.0]) for i in range(70)] + [(2_000, []), (2_010, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows in (50, 1_000):
        got = covertree.top_k(df, df.vec_id % 10 == 0, k=5, block_rows=block_rows)
        assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0, 5)

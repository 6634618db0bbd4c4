import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.llm import kmeans_tree, queries


def brute(rows, is_query, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good.items():
        if is_query(q):
            scored = sorted((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 10), i) for i, b in good.items() if i != q and len(a) == len(b))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in found}) for q, found in want.items())
    return hits / sum(map(len, want.values()))


def test_best_bin_first_reaches_every_leaf_nearest_first():
    rng = np.random.default_rng(1)
    points = kmeans_tree.units(rng.normal(size=(3000, 8)))
    tree = kmeans_tree.Tree()
    tree.grow(0, points, rng)
    leaves = {i for i, c in enumerate(tree.children) if not c}
    assert len(leaves) > 20 and set(tree.assign(points)) <= leaves
    order = list(tree.visits(points[0]))
    assert len(order) == len(leaves) and set(order) == leaves


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "SAMPLE_ROWS", 800)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 10))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.5 * rng.normal(size=10)]) for i in range(2500)]
    rows += [(i, rows[50][1]) for i in range(3000, 3300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = by_query(kmeans_tree.search(df, df.vec_id % 50 == 0, block_rows=50))
    want = brute(rows, lambda i: i % 50 == 0, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v) for i, v in rows}
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(vectors[q] @ vectors[i] / np.linalg.norm(vectors[q]) / np.linalg.norm(vectors[i]), abs=1e-12)
    assert [i for i, _ in got[3050]] == [50, 3000, 3001, 3002, 3003]
    assert [i for i, _ in got[50]] == [3000, 3001, 3002, 3003, 3004]


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0]), (6, []), (7, [0.0, 0.0]), (None, [1.0, 1.0]), (8, [1e200, 1e200]), (8, [1e200, 1e200]), (9, [-3.0, 1e-200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as rank", "'y' as leaf")
    got = by_query(kmeans_tree.search(df, df.vec_id >= 0))
    want = brute([(i, [x / 1e200 for x in v] if i == 8 else v) for i, v in rows], lambda i: True, 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    assert kmeans_tree.search(df.limit(0), df.vec_id >= 0).count() == 0


def test_length_that_the_sample_misses(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "SAMPLE_ROWS", 60)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(600)] + [(1000, [1.0, 2.0]), (1001, [2.0, 1.0]), (1002, [-1.0, 0.5]), (1003, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sampled = df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(60).filter("size(embedding) < 4")
    assert sampled.count() == 0
    got = by_query(kmeans_tree.search(df, (df.vec_id >= 1000) | (df.vec_id < 5)))
    want = brute(rows, lambda i: i >= 1000 or i < 5, 5)
    assert [i for i, _ in got[1000]] == [1001, 1002] and 1003 not in got
    assert got.keys() == {q for q, found in want.items() if found} and all(len(got[q]) == 5 for q in range(5))


def test_query(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0, 5)
    got = by_query(queries.op8_kmeans_tree(spark, path))
    assert got.keys() == want.keys() and recall(got, want) >= 0.9

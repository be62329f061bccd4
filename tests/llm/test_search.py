"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow(rows, k):
    vec = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(1024 * x) for x in v)]
    asked = {}
    for i, v in vec:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v, key=lambda x: (len(x), x))
    out = []
    for q, a in asked.items():
        found = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in vec if i != q and len(v) == len(a))
        out += [(q, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def ours(spark, rows, k=10, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = topk.search(df, F.col("vec_id") % 100 == 0, k, **options).select("query_id", "rank", "vec_id", "score")
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("components", [1 << 20, 900])
def test_against_brute_force(spark, components):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=9).round(2).tolist()) for i in range(1, 500)]
    rows += [(1000 + i, [0.5] * 9) for i in range(300)]  # one common vector
    rows += [(i, [0.5] * 9) for i in (0, 100, 200)]
    want = slow(rows, 10)
    assert ours(spark, rows, shard_components=components) == want


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (500, []), (501, []), (600, [-1e-20, 0.0]), (7, [3.0, 4.0]), (7, [3.0, 4.0]), (0, [1.0, 2.0]), (8, [1e308, 1.0]), (9, [1e200, -1.0]), (10, [5.0]),
    ]
    assert ours(spark, rows) == slow(rows, 10)
    assert ours(spark, []) == []


def test_fewer_than_k_and_extra_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 5, "x"), (1, [2.0], 6, "y")], "vec_id long, embedding array<float>, floor int, id string")
    assert [tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect()] == [(0, 1, 1, 1024 * 2048)]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(size=(700, 5)) * 100)
    tree = topk.BallTree(np.arange(700), vectors)
    queries = np.floor(rng.normal(size=(20, 5)) * 100)
    bounds = tree.bounds(queries)
    for node, (lo, hi) in enumerate(zip(tree.begin, tree.end)):
        assert (bounds[:, node] >= (queries @ tree.vectors[lo:hi].T).max(axis=1)).all()
    assert sorted(tree.ids.tolist()) == list(range(700))

"""Bit planes and centroid clustering against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tickwise.llm import bitplanes

SCHEMA = "vec_id long, embedding array<double>"


def slow(rows, clusters, rounds):
    whole = lambda x: math.floor(256 * x) if math.isfinite(256 * x) else 256 * int(x)
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    width = lambda v: bitplanes.planes_of(np.array([v], object), bitplanes.width(v))[0].view(np.int64).tolist()
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), width(r[1])))
    centroids = [v for _, v in order[:clusters]]

    def assign():
        away = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        return [min(range(len(centroids)), key=lambda n: (d[n], n)) for d in away], away

    for _ in range(rounds):
        at, _ = assign()
        for n in set(at):
            mine = [v for (_, v), a in zip(kept, at) if a == n]
            centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    at, away = assign()
    most = (1 << 63) - 1
    away = [min(d[n], most) for d, n in zip(away, at)]
    inertia = {n: min(most, sum(d for d, a in zip(away, at) if a == n)) for n in set(at)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], min(most, sum(away)), sha[n]) for (i, _), n, d in zip(kept, at, away)), key=str)


def ours(spark, rows, clusters, rounds, schema=SCHEMA):
    got = bitplanes.cluster_rows(spark.createDataFrame(rows, schema), clusters, rounds)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(scope="module")
def rng():
    return np.random.default_rng(6)


def test_against_plain_integers(spark, rng):
    rows = [(i, rng.normal(scale=0.2, size=64).tolist()) for i in range(150)]
    rows += [(1000 + i, [0.125] * 64) for i in range(80)] + [(2000 + i, [3.0 * (i % 2)] * 64) for i in range(9)]
    assert ours(spark, rows, 12, 3) == slow(rows, 12, 3)


def test_odd_rows(spark, rng):
    one = rng.normal(size=64).tolist()
    rows = [
        (0, one), (0, one), (1, None), (2, [None] + one[1:]), (3, [float("nan")] + one[1:]), (4, one[:63]), (5, one + [1.0]), (6, []), (7, [float("-inf")] + one[1:]),
        (None, [0.0] * 64), (None, [-1e-30] * 64), (8, [1e12] + one[1:]), (9, [-1e300] * 64), (10, [1.7e308] * 64), (11, [0.0] * 64),
    ]
    assert ours(spark, rows, 4, 2) == slow(rows, 4, 2)
    assert ours(spark, [], 4, 2) == []
    assert ours(spark, [(1, None)], 4, 2) == []


def test_extra_columns_and_floats(spark, rng):
    rows = [(i, rng.normal(size=64).astype(np.float32).tolist(), "x", i) for i in range(30)]
    got = ours(spark, rows, 40, 2, "vec_id long, embedding array<float>, cluster string, planes long")
    assert got == slow([r[:2] for r in rows], 40, 2)


def test_dots_and_widths():
    rng = random.Random(1)
    for bits in (1, 5, 28, 29, 70, 200):
        rows = [[rng.randint(-(1 << bits), 1 << bits) for _ in range(64)] for _ in range(4)]
        planes = [bitplanes.planes_of(np.array([r], object), bitplanes.width(r))[0] for r in rows]
        assert [bitplanes.unpack(p) for p in planes] == rows
        for a, p in zip(rows, planes):
            for b, q in zip(rows, planes):
                assert int(bitplanes.dots(p[None], q[None])[0, 0]) == sum(x * y for x, y in zip(a, b))

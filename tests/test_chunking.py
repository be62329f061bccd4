"""Chunked operators equal their sequential definitions for any chunk size."""

import random

import pytest
from pyspark.sql import functions as F

from tickwise.operators.fold import run_fold, sequential_fold
from tickwise.operators.scan import Affine, affine_scan, sequential_affine
from tickwise.operators.series import halo_window, prefix_sum, sequence


@pytest.mark.parametrize("chunk", [2, 64])
def test_affine_scan_matches_sequential(spark, chunk):
    rnd = random.Random(chunk)
    rows = []
    for key in ("a", "b"):
        for i in range(1, 151):
            rows.append((key, i, rnd.uniform(0.1, 0.99), rnd.uniform(-5, 5)))
    df = spark.createDataFrame(rows, "k string, seq bigint, a double, b double")
    out = affine_scan(df, ["k"], [Affine("y", F.col("a"), F.col("b"))], chunk_rows=chunk).orderBy("k", "seq").collect()
    for key in ("a", "b"):
        got = [r.y for r in out if r.k == key]
        src = [r for r in rows if r[0] == key]
        exp = sequential_affine([r[2] for r in src], [r[3] for r in src])
        assert max(abs(x - y) for x, y in zip(got, exp)) < 1e-9


@pytest.mark.parametrize("chunk", [1, 16])
def test_sequence_halo_prefix(spark, chunk):
    rows = [("k", t * 10, float(t % 7)) for t in range(0, 200) if t % 3 != 1]
    df = spark.createDataFrame(rows, "k string, t bigint, x double")
    s = sequence(df, ["k"], ["t"], F.floor(F.col("t") / 50))
    s = halo_window(s, ["k"], lambda w: {"m5": F.max("x").over(w.rowsBetween(-4, 0)), "nxt": F.lead("x", 1).over(w)}, 4,
                    chunk_rows=chunk, ahead=1)
    s = prefix_sum(s, ["k"], {"cum": F.col("x")}, chunk_rows=chunk)
    got = s.orderBy("seq").collect()
    xs = [r[2] for r in rows]
    assert [r.seq for r in got] == list(range(1, len(rows) + 1))
    for i, r in enumerate(got):
        assert r.m5 == max(xs[max(0, i - 4): i + 1])
        assert r.nxt == (xs[i + 1] if i + 1 < len(xs) else None)
        assert abs(r.cum - sum(xs[: i + 1])) < 1e-9


def test_fold_repairs_match_sequential(spark):
    from tickwise.strategies.ema_cross import EmaCross

    s = EmaCross()
    rnd = random.Random(3)
    rows = []
    for key in ("p", "q"):
        f = sl = 100.0
        for i in range(1, 301):
            close = 100 + rnd.uniform(-10, 10)
            f, sl = 0.7 * f + 0.3 * close, 0.9 * sl + 0.1 * close
            rows.append(("x", key, i, i, close, f, sl))
    df = spark.createDataFrame(rows, "exchange string, symbol string, seq bigint, ts_ms bigint, close double, fast_ema double, slow_ema double")
    for chunk in (5, 64):
        got = run_fold(df, ["exchange", "symbol"], s, chunk_rows=chunk).orderBy("symbol", "seq").collect()
        for key in ("p", "q"):
            src = [r for r in rows if r[1] == key]
            exp = sequential_fold([(r[4], r[5], r[6]) for r in src], s)
            assert [(i + 1, sig[0]) for i, sig in exp] == [(r.seq, r.kind) for r in got if r.symbol == key]


@pytest.mark.parametrize("chunk", [3, 500])
def test_fed_scan_matches_sequential(spark, chunk):
    """A recurrence that reads the previous values of two others, over many levels of chunks."""
    rnd = random.Random(chunk)
    rows = [(key, i, *[rnd.uniform(-0.9, 0.9) for _ in range(8)]) for key in ("a", "b") for i in range(1, 121)]
    df = spark.createDataFrame(rows, "k string, seq bigint, a1 double, b1 double, a2 double, b2 double, a3 double, b3 double, f1 double, f2 double")
    specs = [Affine("x", F.col("a1"), F.col("b1")), Affine("y", F.col("a2"), F.col("b2")),
             Affine("z", F.col("a3"), F.col("b3"), {"x": F.col("f1"), "y": F.col("f2")})]
    out = affine_scan(df, ["k"], specs, chunk_rows=chunk).collect()
    got = {(r.k, r.seq): (r.x, r.y, r.z) for r in out}
    for key in ("a", "b"):
        x = y = z = 0.0
        for _, i, a1, b1, a2, b2, a3, b3, f1, f2 in (r for r in rows if r[0] == key):
            z = a3 * z + b3 + f1 * x + f2 * y
            x, y = a1 * x + b1, a2 * y + b2
            assert max(abs(p - q) for p, q in zip(got[key, i], (x, y, z))) < 1e-9

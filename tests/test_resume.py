"""Null keys, series resumed from snapshots, and many settings in one job."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tickwise.operators import snapshot as snap
from tickwise.operators.scan import Affine, affine_scan
from tickwise.operators.series import carried, forward_fill, halo_window, next_value, prefix_sum, sequence, sequence_rows
from tickwise.plans import catalog
from tickwise.strategies.bandtastic import Bandtastic, BandtasticParams
from tickwise.strategies.base import REGISTRY
from tickwise.strategies.mtf_macd import MultiTimeFrameMacd
from tickwise.strategies.sweep import sweep

SF = "/root/testdata/sf0.001"
KEYS = ["exchange", "symbol"]


@pytest.fixture(scope="module")
def null_keyed(spark):
    rows = [("x", "a", i, float(i)) for i in range(1, 6)] + [(None, "a", i, 1.0) for i in range(1, 5)] + [("x", None, i, 2.0) for i in range(1, 4)]
    return spark.createDataFrame(rows, "exchange string, symbol string, seq bigint, v double")


def test_null_keys_are_series_of_their_own(null_keyed):
    d = null_keyed
    want = sorted(map(str, d.select(*KEYS, "seq").collect()))
    for numbered in (sequence(d, KEYS, ["seq"], F.floor(F.col("seq") / 2), "n"), sequence_rows(d, KEYS, ["seq"], "n")):
        assert sorted(map(str, numbered.select(*KEYS, F.col("n").alias("seq")).collect())) == want
    sums = prefix_sum(d, KEYS, {"s": F.lit(1)}, chunk_rows=2)
    assert sorted(map(str, sums.select(*KEYS, F.col("s").cast("bigint").alias("seq")).collect())) == want
    filled = forward_fill(d, KEYS, ["v"], F.col("seq") == 1, chunk_rows=2).collect()
    assert len(filled) == 12 and all(r.v_asof == (2.0 if r.symbol is None else 1.0) for r in filled)
    lagged = halo_window(d, KEYS, lambda w: {"p": F.lag("seq", 1).over(w)}, 1, chunk_rows=2).collect()
    assert all(r.p == (r.seq - 1 or None) for r in lagged) and len(lagged) == 12
    scanned = affine_scan(d, KEYS, [Affine("y", F.lit(1.0), F.lit(1.0))], chunk_rows=2).collect()
    assert len(scanned) == 12 and all(r.y == r.seq for r in scanned)
    assert carried(d, KEYS, "seq", {"before": ("sum", "v")}).count() == 12


def test_null_keys_have_signals(spark):
    bars = catalog.bars(spark, SF, 15).filter("symbol = 'CLICK'")
    strat = Bandtastic(catalog.BT_ACTIVE)
    want = strat.signals(bars, chunk_rows=16).count()
    got = strat.signals(bars.withColumn("symbol", F.lit(None).cast("string")), chunk_rows=16).collect()
    assert len(got) == want > 0 and all(r.symbol is None for r in got)


def test_scan_goes_on_from_initial_values(spark):
    rng = random.Random(1)
    rows = [(k, i, rng.random()) for k in ("a", None) for i in range(1, 41)]
    d = spark.createDataFrame(rows, "k string, seq bigint, v double").withColumn("base", F.lit(13).cast("bigint"))
    spec = [Affine("y", F.lit(0.5), F.col("v"))]
    whole = {(r.k, r.seq): r.y for r in affine_scan(d, ["k"], spec, chunk_rows=4).collect()}
    start = spark.createDataFrame([(k, whole[k, 13]) for k in ("a", None)], "k string, y double")
    rest = affine_scan(d.filter("seq > 13"), ["k"], spec, chunk_rows=4, base_col="base", initial=start).collect()
    assert len(rest) == 54 and all(r.y == pytest.approx(whole[r.k, r.seq], abs=1e-12) for r in rest)


@pytest.mark.parametrize("name,widths", [("bandtastic", 15), ("mtf_macd", [60, 240]), ("ema_cross", 15)])
def test_resumed_runs_equal_one_run(spark, name, widths):
    strat = {"bandtastic": lambda: Bandtastic(catalog.BT_ACTIVE), "mtf_macd": MultiTimeFrameMacd}.get(name, REGISTRY[name])()
    bars = catalog.bars(spark, SF, widths).cache()
    key = lambda df: sorted((r.symbol, r.seq, r.ts_ms, r.kind, str(r.direction), str(r.reason), r.price) for r in df.collect())
    want = key(strat.signals(bars, chunk_rows=16))
    edges = bars.select(F.percentile_approx("close_time_ms", [0.02, 0.5])).first()[0]
    at = F.col("close_time_ms")
    quiet = F.col("symbol") != "CLICK"  # this symbol has no bar in the second run
    parts = [at <= edges[0], (at > edges[0]) & (at <= edges[1]) & quiet, ((at > edges[0]) & ~quiet) | (at > edges[1])]
    got, snapshot = [], None
    for part in parts:
        found, snapshot = strat.resume(bars.filter(part), snapshot, chunk_rows=16)
        got += key(found)
    assert sorted(got) == want and want
    ends = {(r.symbol, r.series): r.seq for r in snapshot.collect()}
    assert len(ends) == snapshot.count()
    assert sum(n for (_, s), n in ends.items() if s == "main") == bars.count()
    late = snap.late_bars(bars, snapshot)
    assert late.count() == bars.count()


def test_sweep_equals_single_runs(spark):
    bars = catalog.bars(spark, SF, 15).cache()
    chosen = {n: catalog.SWEEP[n] for n in ("s00", "s12", "s25", "s36", "s49")}
    table = spark.createDataFrame([(n, json.dumps(s)) for n, s in chosen.items()] + [("default", None)], "setting string, params string")
    got = sweep(bars, table, chunk_rows=16)
    key = lambda rows: sorted((r.symbol, r.seq, r.kind, str(r.reason), r.price) for r in rows)
    rows = got.collect()
    for name, settings in [*chosen.items(), ("default", {})]:
        want = Bandtastic(BandtasticParams.from_json(settings)).signals(bars, chunk_rows=16).collect()
        assert key([r for r in rows if r.setting == name]) == key(want)
    with pytest.raises(ValueError, match="twice"):
        sweep(bars, table.unionByName(table))


def test_next_value_over_ranges(spark, null_keyed):
    for partitions in ("1", "4", "30"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = next_value(null_keyed.repartition(5), KEYS, ["seq"], "seq", "n").collect()
        last = {(None, "a"): 4, ("x", "a"): 5, ("x", None): 3}
        assert len(got) == 12 and all(r.n == (r.seq + 1 if r.seq < last[r.exchange, r.symbol] else None) for r in got)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert next_value(null_keyed.limit(0), KEYS, ["seq"], "seq", "n").count() == 0


def test_resumed_runs_read_written_bars(spark):
    """Each run's bars come from one written table: the events are not aggregated again for every look at them."""
    given = []

    class Looks:
        def resume(self, bars, snapshot, chunk_rows):
            given.append(bars)
            return bars.select(*[F.lit(None).cast("string").alias(c) if c not in bars.columns else F.col(c) for c in catalog.SIG_COLS]), None

    catalog.resumed(spark, SF, Looks(), [60, 240])
    assert len(given) == 3 and not any("events.parquet" in f for b in given for f in b.inputFiles())
    assert sum(b.count() for b in given) == catalog.bars(spark, SF, [60, 240]).count()

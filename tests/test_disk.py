"""What a query leaves and moves on disk: shuffle files, written tables, shuffled columns."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tickwise import session
from tickwise.operators import fold, scan, series
from tickwise.operators.fold import run_fold
from tickwise.operators.scan import Affine, affine_scan
from tickwise.operators.series import halo_window, sequence
from tickwise.strategies import bandtastic
from tickwise.strategies.bandtastic import Bandtastic, BandtasticParams

DAY = 86_400_000
KEYS = ["exchange", "symbol"]
PARAMS = BandtasticParams(buy_rsi_enabled=False, buy_mfi_enabled=False, interval="1d", bar_minutes=1440)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_job_that_wrote_them(spark):
    before, was = shuffle_files(spark), spark.conf.get(session._SHUFFLE_CLEANUP, None)
    table = session.materialize(spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and table.count() == 7
    assert spark.conf.get(session._SHUFFLE_CLEANUP, None) == was


def test_a_released_table_is_gone(spark):
    table, other = session.materialize(spark.range(3)), session.materialize(spark.range(4), "zstd")
    path = session._PATHS[table]
    session.release(table)
    assert not os.path.exists(path.removeprefix("file:")) and path not in session._WRITTEN and other.count() == 4


@pytest.fixture(scope="module")
def daily(spark):
    """Daily bars with gaps and longer than several chunks, one key of them null, and bars of another interval."""
    rng, rows = random.Random(5), []
    for symbol, n in (("a", 260), (None, 190), ("b", 1)):
        day, price = 0, 100.0
        for _ in range(n):
            day, price = day + rng.choice([1, 1, 2, 90]), price * rng.uniform(0.9, 1.1)
            bar = (day * DAY, day * DAY + DAY - 1, "label", price, price * rng.uniform(1, 1.05), price * rng.uniform(0.95, 1), price, float(rng.randint(0, 9)), 1)
            rows += [("x", symbol, *bar[:3], i, *bar[3:]) for i in ("1d", "1h")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "exchange string, symbol string, open_time_ms bigint, close_time_ms bigint, open_time_h string, interval string, "
                                       "open double, high double, low double, close double, volume double, trades_count bigint")


@pytest.mark.parametrize("chunk", [1, 16, 64, 1024])
def test_signals_are_the_fold_of_the_features(spark, daily, chunk):
    s = Bandtastic(PARAMS)
    held = spark.createDataFrame([("x", None, 1e6, 0)], "exchange string, symbol string, pos_price double, pos_index bigint")
    for state in (None, held):
        got = s.signals(daily, chunk, state).collect()
        want = run_fold(s.features(daily, chunk), KEYS, s, chunk_rows=chunk, initial_state=state).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and {r.symbol for r in got} >= {"a", None}


def test_signals_write_narrow_tables_and_drop_them(spark, daily, monkeypatch):
    """Before: a table of all bar and window columns and 12 coefficients a row, and none dropped."""
    tables, real = [], session.materialize

    def kept(df, *more):
        tables.append((df.columns, session._WRITTEN[:]))
        return real(df, *more)

    for module in (bandtastic, fold, scan, series):
        monkeypatch.setattr(module, "materialize", kept)
    before = set(session._WRITTEN)
    Bandtastic(PARAMS).signals(daily, 16)
    by_row = [c for c, _ in tables if "close" in c or "_ca_buy_fast_ema" in c]
    assert len(by_row) == 3 and all(len(c) <= 10 for c in by_row)
    # The fold's rows are written when the bars are gone, and the numbered bars go after.
    assert len(set(tables[-1][1]) - before) < len(tables) - 1
    left = set(session._WRITTEN) - before
    assert len(left) == len(tables) - 2


@pytest.mark.parametrize("chunk", [2, 16])
def test_scan_of_dealt_rows_shuffles_and_writes_none(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    rows = [(k, i, rng.uniform(0.1, 0.99), rng.uniform(-5, 5)) for k in ("a", None) for i in range(1, 101)]
    d = spark.createDataFrame(rows, "k string, seq bigint, a double, b double")
    specs = [Affine("y", F.col("a"), F.col("b")), Affine("z", F.col("a"), F.col("b"), {"y": F.col("before")})]
    lag = lambda w: {"before": F.coalesce(F.lag("b", 1).over(w), F.lit(0.0))}
    want = affine_scan(halo_window(d, ["k"], lag, 1, chunk_rows=chunk), ["k"], specs, chunk_rows=chunk)
    written, real = [], scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda df: written.append(df.columns) or real(df))
    dealt = halo_window(d.select(F.struct("k").alias("_key"), "seq", "a", "b"), ["_key"], lag, 1, chunk_rows=chunk, chunk_col="_chunk")
    got = affine_scan(dealt, ["_key"], specs, chunk_rows=chunk, chunk_col="_chunk")
    assert all("before" not in c for c in written)  # maps of chunks only
    result = got.select("_key.k", "seq", "y", "z").collect()
    assert sorted(map(str, result)) == sorted(map(str, want.select("k", "seq", "y", "z").collect())) and len(result) == 200
    dealt_by_scan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")
    assert dealt_by_scan(got) == dealt_by_scan(want) - 1  # the maps' levels only


def test_numbering_keeps_the_columns_in_place(spark):
    d = spark.createDataFrame([("b", 2, "x"), ("a", 1, None), ("c", 3, "x")], "v string, t bigint, k string")
    out = sequence(d, ["k"], ["t"], F.floor(F.col("t") / 2), base_col="base")
    assert out.columns == ["v", "t", "k", "seq", "base"]
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 1, None, 1, 0), ("b", 2, "x", 1, 0), ("c", 3, "x", 2, 0)]
    again = sequence(out, ["k"], ["t"], F.floor(F.col("t") / 2))
    assert again.columns == out.columns


def test_offsets_written_first_give_the_same_numbers(spark, daily):
    bucket, order = F.floor(F.col("close_time_ms") / (DAY * 64)), ["close_time_ms", "interval"]
    plain = sequence(daily, KEYS, order, bucket)
    first = sequence(daily, KEYS, order, bucket, counted_first=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, first.collect()))
    scans = first._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert scans == 1  # the offsets are a table: the bars are looked at once

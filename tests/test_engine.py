"""The rule engine, row-bounded numbering, carries and the small text rules."""

import random

import pytest
from pyspark.sql import functions as F

from tickwise.functions import intervals as iv
from tickwise.functions import numbers as nb
from tickwise.operators import fold
from tickwise.operators.ledger import trade_ledger
from tickwise.operators.sanity import bar_sanity
from tickwise.operators.series import carried, forward_fill, sequence_rows
from tickwise.sinks import alerts, archive
from tickwise.strategies.bandtastic import Bandtastic, BandtasticParams
from tickwise.strategies.mtf_macd import MultiTimeFrameMacd

BT_ROWS = "exchange string, symbol string, seq bigint, ts_ms bigint, close double, high100 double, buy boolean, sell boolean"


def counted_writes(monkeypatch, run):
    calls, real = [], fold.materialize
    monkeypatch.setattr(fold, "materialize", lambda df: calls.append(1) or real(df))
    out = run()
    monkeypatch.setattr(fold, "materialize", real)
    return out, len(calls)


def held_position(spark, chunks, rows=8):
    """One entry on the second bar; the price stays quiet until the last chunk."""
    n = chunks * rows
    data = [("x", "s", i, i, 100.0 if i < n - 3 else 130.0, 100.0, i == 2, False) for i in range(1, n + 1)]
    return spark.createDataFrame(data, BT_ROWS)


def test_long_positions_cost_no_rounds(spark, monkeypatch):
    s = Bandtastic(BandtasticParams(min_roi=((0, 0.2),)))
    seen = {}
    for chunks in (5, 200):
        df = held_position(spark, chunks)
        got, seen[chunks] = counted_writes(monkeypatch, lambda df=df: fold.run_fold(df, ["exchange", "symbol"], s, chunk_rows=8).orderBy("seq").collect())
        assert [(r.seq, r.kind, r.reason) for r in got] == [(2, "Enter", None), (chunks * 8 - 3, "Exit", "Roi")]
    assert seen[5] == seen[200] <= 8


@pytest.mark.parametrize("chunk", [5, 500])
def test_rules_by_chunk_equal_bar_by_bar(spark, chunk):
    rng = random.Random(chunk)
    bt = Bandtastic(BandtasticParams(min_roi=((0, 0.2), (45, 0.1), (90, 0.02)), stoploss=-0.1, trailing_only_offset_is_reached=True))
    macd = MultiTimeFrameMacd()
    price, rows, mrows = 100.0, [], []
    for i in range(1, 401):
        price = max(1.0, price * (1 + rng.uniform(-0.03, 0.03)))
        rows.append((i, price, price * rng.uniform(1.0, 1.2), rng.random() < 0.1, rng.random() < 0.01))
        mrows.append((i, price, rng.random() < 0.1, rng.random() < 0.1, rng.random() < 0.01, rng.random() < 0.01))
    for s, data, types in (
        (bt, rows, "seq bigint, close double, high100 double, buy boolean, sell boolean"),
        (macd, mrows, "bar_index bigint, close double, long_entry boolean, short_entry boolean, long_exit boolean, short_exit boolean"),
    ):
        df = spark.createDataFrame([("x", "s", i + 1, i + 1, *r) for i, r in enumerate(data)], "exchange string, symbol string, seq0 bigint, ts_ms bigint, " + types)
        df = df.withColumn("seq", F.col("seq0")) if "seq" not in s.row_columns else df
        got = fold.run_fold(df, ["exchange", "symbol"], s, chunk_rows=chunk).orderBy("seq").collect()
        want = fold.sequential_fold(data, s)
        assert [(r.seq, r.kind, r.direction, r.reason, r.roi_minutes, r.price) for r in got] == [(i + 1, g[0], g[1], g[2], g[3], g[5]) for i, g in want]
        assert len(want) > 10


def test_restored_position_goes_through_quiet_chunks(spark):
    s = Bandtastic(BandtasticParams(min_roi=((0, 0.2),)))
    given = spark.createDataFrame([("x", "s", 100.0, 0)], "exchange string, symbol string, pos_price double, pos_index bigint")
    data = [("x", "s", i, i, 100.0 if i < 90 else 125.0, 100.0, False, False) for i in range(1, 100)]
    got = fold.run_fold(spark.createDataFrame(data, BT_ROWS), ["exchange", "symbol"], s, chunk_rows=8, initial_state=given).collect()
    assert [(r.seq, r.kind, r.reason) for r in got] == [(90, "Exit", "Roi")]


def test_hot_key_is_numbered_in_bounded_groups(spark):
    rows = [("hot" if i % 3 else f"k{i % 50}", i * 7919 % 10_000, i) for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint").repartition(16)
    out = sequence_rows(df, ["k"], ["t", "i"])
    want = {}
    for n, (k, t, i) in enumerate(sorted(rows)):
        want.setdefault(k, []).append(i)
    got = {}
    for r in out.orderBy("k", "seq").collect():
        got.setdefault(r.k, []).append((r.seq, r.i))
    assert {k: [(n + 1, i) for n, i in enumerate(v)] for k, v in want.items()} == got
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small partitions are merged
    parts = df.repartitionByRange("k", "t", "i").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in parts) < len(rows) / 2


def test_carries_in_two_levels(spark, monkeypatch):
    from tickwise.operators import series

    monkeypatch.setattr(series, "CARRY_GROUP", 4)
    rows = [("a", p, p * 10, p if p % 5 == 0 else None) for p in range(-3, 40) if p % 3]
    df = spark.createDataFrame(rows, "k string, p bigint, n bigint, v bigint")
    got = {r.p: (r.s, r.l) for r in carried(df, ["k"], "p", {"s": ("sum", "n"), "l": ("last", "v")}).collect()}
    for _, p, _, _ in rows:
        seen = [r for r in rows if r[1] < p]
        last = [r[3] for r in seen if r[3] is not None]
        assert got[p] == (sum(r[2] for r in seen), last[-1] if last else None)
    filled = forward_fill(spark.createDataFrame([("a", i, i) for i in range(1, 60)], "k string, seq bigint, x bigint"), ["k"], ["x"], F.col("x") % 13 == 0, chunk_rows=3)
    assert all(r.x_asof == (r.x // 13 * 13 or None) for r in filled.collect())


def test_ledger_pairs_exits_with_the_latest_entry(spark):
    kinds = ["Exit", "Enter", "Enter", "Exit", "Exit", "Enter", "Exit", "Enter"]
    rows = [("x", "s", i, i * 10, k, "Long" if k == "Enter" else None, "StopLoss" if k == "Exit" else None, None, None, 100.0 + i) for i, k in enumerate(kinds)]
    sig = spark.createDataFrame(rows, "exchange string, symbol string, seq bigint, ts_ms bigint, kind string, direction string, reason string, roi_minutes bigint, roi_pct double, price double")
    got = sorted((r.enter_time, r.exit_time, r.event, r.direction, r.enter_price, r.exit_price) for r in trade_ledger(sig, chunk_rows=2).na.fill(-1.0).collect())
    assert got == [
        (10, 0, "open", "Long", 101.0, -1.0), (10, 30, "close", "LongClose", 101.0, 103.0),
        (50, 0, "open", "Long", 105.0, -1.0), (50, 60, "close", "LongClose", 105.0, 106.0), (70, 0, "open", "Long", 107.0, -1.0),
    ]


@pytest.mark.parametrize("x,display,debug", [
    (1e-20, "0.00000000000000000001", "1e-20"), (1.2345678901234568e-05, "0.000012345678901234568", "1.2345678901234568e-5"),
    (1e21, "1000000000000000000000", "1e21"), (-2.5e8, "-250000000", "-250000000.0"), (1.5e7, "15000000", "15000000.0"), (12345678.9, "12345678.9", "12345678.9"),
    (0.0, "0", "0.0"), (-0.0005, "-0.0005", "-0.0005"), (3.25, "3.25", "3.25"), (-7.0, "-7", "-7.0"), (1.25e20, "125000000000000000000", "1.25e20"),
])
def test_number_text(spark, x, display, debug):
    import duckdb

    r = spark.createDataFrame([(x,)], "x double").select(nb.display_number("x").alias("d"), nb.debug_number("x").alias("g")).first()
    assert (r.d, r.g) == (display, debug)
    assert duckdb.sql(f"SELECT {nb.sql_display_number('x')}, {nb.sql_debug_number('x')} FROM (SELECT CAST({x!r} AS DOUBLE) AS x)").fetchall() == [(display, debug)]


def test_strict_price_text(spark):
    texts = ["1.5\n", "+nan", "-NaN", "nan", "inf", "-Infinity", "1.5", " 1", "1d"]
    got = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(nb.parse_price("t").alias("p")).collect()]
    assert got[0] == 0.0 and all(p != p for p in got[1:4]) and got[4:] == [float("inf"), float("-inf"), 1.5, 0.0, 0.0]


def test_interval_names_off_the_wire(spark):
    names = ["15m", "1h", "99999999999999999999m", "9999999999999999d", "15m\n", "x", None]
    got = [r.m for r in spark.createDataFrame([(n,) for n in names], "n string").select(iv.interval_minutes("n").alias("m")).collect()]
    assert got == [15, 60, None, None, None, None, None]


def test_every_sanity_reason(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1.0, 2.0, 0.5, 1.5, 1.0), (None, 2.0, 0.5, 1.5, 1.0), (nan, 2.0, 0.5, 1.5, 1.0), (1.0, inf, 0.5, 1.5, 1.0), (1.0, 0.4, 0.5, 1.5, 1.0),
            (3.0, 2.0, 0.5, 1.5, 1.0), (1.0, 2.0, 0.5, 2.5, 1.0), (1.0, 2.0, 0.5, 1.5, -1.0)]
    good, bad = bar_sanity(spark.createDataFrame(rows, "open double, high double, low double, close double, volume double"))
    assert good.count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == sorted(
        ["missing", "nan", "infinite", "low_above_high", "open_outside_range", "close_outside_range", "negative_volume"])


def test_archive_files_and_rejects(spark, tmp_path):
    import glob

    from tickwise.plans import catalog

    bars = catalog.bars(spark, "/root/testdata/sf0.001").repartition(8)
    path = str(tmp_path / "a")
    archive.archive_bars(bars, path)
    periods = archive.with_period(bars).select("period").distinct().count()
    assert len(glob.glob(f"{path}/period=*/*.parquet")) == periods
    text = str(tmp_path / "t")
    archive.archive_bars(bars, text, fmt="json")
    assert archive.read_archive(spark, text, "json").count() == bars.count() and archive.archive_rejects(spark, text).count() == 0
    lines = spark.createDataFrame([("not json",), ('{"symbol":"A","open_time_ms":1}',), ('{"symbol":"A"}',), ('[3,{"symbol":"B","open_time_ms":2}]',), ("[1]",), ("",)], "value string")
    good, bad = archive.parse_lines(lines)
    assert sorted(r.symbol for r in good.collect()) == ["A", "B"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["incomplete", "malformed", "malformed", "malformed"]


def test_payloads_are_handed_to_the_sender(spark, tmp_path):
    out = tmp_path / "sent"
    out.mkdir()

    def send(rows):
        import os
        import uuid

        for r in rows:
            with open(os.path.join(str(out), uuid.uuid4().hex), "w") as f:
                f.write(r.url + " " + r.body)

    starts = spark.createDataFrame([(5,)], "ts_ms bigint")
    payloads = alerts.fan_out(alerts.start_alerts(starts), ["u1", "u2"])
    alerts.send_batch(send)(payloads, 0)
    texts = sorted(p.read_text() for p in out.iterdir())
    assert len(texts) == 2 and texts[0].startswith("u1 {") and alerts.START_MESSAGE in texts[1]


def test_materialized_tables_are_dropped(spark):
    import os

    from tickwise import session

    kept, session._WRITTEN[:] = list(session._WRITTEN), []
    df = session.materialize(spark.range(3))
    path = session._WRITTEN[0].removeprefix("file:")
    assert df.count() == 3 and os.path.isdir(path)
    session.drop_materialized(spark)
    assert not os.path.exists(path) and not session._WRITTEN
    session._WRITTEN[:] = kept


def test_only_accepted_intervals_advance_the_bar_index(spark):
    from tickwise.plans import catalog

    bars = catalog.bars(spark, "/root/testdata/sf0.001", [15, 60, 240])
    s = MultiTimeFrameMacd()
    merged = s.merged(s.accepted(bars), 64)
    assert {r.interval_c for r in merged.select("interval_c").distinct().collect()} == {"60m", "240m"}
    short = merged.filter("is_short").groupBy("symbol").agg(F.count("*").alias("n"), F.max("bar_index").alias("m"))
    assert all(r.n == r.m for r in short.collect())


def test_unknown_trigger_and_zero_volume_never_signal(spark):
    from tickwise.strategies.bandtastic import buy_condition, sell_condition

    row = spark.createDataFrame([(10.0, 20.0, 2.0, 1.0, 5.0, 9.0, 1.0, 100.0, 0.0), (10.0, 20.0, 2.0, 1.0, 5.0, 9.0, 1.0, 100.0, 3.0)],
                                "rsi double, mfi double, buy_fast_ema double, buy_slow_ema double, close double, bb_lower1 double, bb_upper1 double, bb_upper2 double, volume double")
    row = row.withColumns({"sell_fast_ema": F.lit(1.0), "sell_slow_ema": F.lit(2.0)})
    bt = lambda **kw: BandtasticParams(sell_mfi_enabled=False, **kw)
    got = row.select(
        buy_condition(bt()).alias("b"), sell_condition(bt(sell_trigger="sell-bb_upper1")).alias("s"),
        buy_condition(bt(buy_trigger="odd")).alias("bo"), sell_condition(bt(sell_trigger="odd")).alias("so"),
    ).collect()
    assert [tuple(r) for r in got] == [(False, False, False, False), (True, True, False, False)]


def test_open_frames_take_an_index_too(spark):
    from tickwise.sources.frames import symbol_index

    df = spark.createDataFrame([(1, 0, "B", False), (2, 0, "A", True), (3, 0, "B", True)], "recv_ms bigint, frame_no int, symbol string, closed boolean")
    assert {r.symbol: r.symbol_index for r in symbol_index(df).collect()} == {"B": 1, "A": 2}


def test_tick_rejects_name_their_reason(spark):
    from tickwise.sources.bars import event_fault, event_ticks, tick_rejects

    df = spark.createDataFrame([(1, None, "a", 1.0), (2, "2024-01-01 00:00:00", None, 1.0), (3, "2024-01-01 00:00:00", "a", None), (4, "2024-01-01 00:00:00", "a", 2.0)],
                               "event_id bigint, t string, event_type string, value double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    assert sorted((r.event_id, r.reject_reason) for r in tick_rejects(df, event_fault()).collect()) == [(1, "no_time"), (2, "no_symbol"), (3, "no_price")]
    assert event_ticks(df).count() == 1

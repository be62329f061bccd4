"""Stream = batch: bars arrive as several time-ordered files, each processed by
a separate availableNow run on the same checkpoint (a restart per batch),
with one replayed file; the signals equal the batch fold."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from tickwise.operators.ledger import trade_ledger
from tickwise.plans import catalog
from tickwise.sources.bars import event_ticks, resample_bars
from tickwise.sources.frames import collapse_updates
from tickwise.strategies.bandtastic import Bandtastic
from tickwise.strategies.mtf_macd import MultiTimeFrameMacd
from tickwise.streaming import bars as sb
from tickwise.streaming.collapse import stream_collapse
from tickwise.streaming.replay import BATCHES, FILE_ROWS, STATE_ROWS, read_in_order, replay, run_to_end, start, state_partitions, write_in_order
from tickwise.streaming.stateful import evaluate_stream, late_of, signals_of, stream_signals, trades_of

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_across_restarts(spark):
    strat = Bandtastic(catalog.BT_ACTIVE)
    bars = catalog.bars(spark, SF, 15)
    expected = sorted(
        (r.symbol, r.ts_ms, r.kind, r.reason) for r in strat.signals(bars, chunk_rows=64).collect()
    )
    root = tempfile.mkdtemp(prefix="tw-stream-test-")
    src, out, ckpt = (os.path.join(root, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    edges = bars.select(F.percentile_approx("close_time_ms", [0.25, 0.5, 0.75])).first()[0]
    bounds = [None, *edges, None]
    parts = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("close_time_ms") > lo)
        if hi is not None:
            cond = cond & (F.col("close_time_ms") <= hi)
        parts.append(bars.filter(cond))
    parts.insert(2, parts[0])  # a replayed slice: must be skipped as late
    for i, part in enumerate(parts):
        part.write.mode("overwrite").parquet(os.path.join(src, f"part{i}"))
        stream = spark.readStream.schema(bars.schema).option("recursiveFileLookup", "true").parquet(src)
        run_to_end(stream_signals(stream, strat), out, ckpt)
    got = sorted((r.symbol, r.ts_ms, r.kind, r.reason) for r in spark.read.parquet(out).collect())
    assert got == expected
    assert len(expected) > 0


def feed(spark, strat, parts, schema, **options):
    """Run each part as its own availableNow run on one checkpoint (a restart per part)."""
    root = tempfile.mkdtemp(prefix="tw-stream-test-")
    src, out, ckpt = (os.path.join(root, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(src)
        run_to_end(evaluate_stream(stream, strat, **options), out, ckpt)
    return spark.read.parquet(out)


def test_intervals_may_come_in_separate_batches(spark):
    """The 240m bars of each time slice come one run after its 60m bars."""
    strat = MultiTimeFrameMacd()
    bars = catalog.bars(spark, SF, [60, 240])
    want = sorted((r.symbol, r.ts_ms, r.kind, r.reason) for r in strat.signals(bars, chunk_rows=64).collect())
    middle = bars.select(F.percentile_approx("close_time_ms", 0.5)).first()[0]
    halves = (F.col("close_time_ms") <= middle, F.col("close_time_ms") > middle)
    long = F.col("close_time_ms") - F.col("open_time_ms") > 2 * 3600 * 1000
    parts = [bars.filter(half & i) for half in halves for i in (~long, long)]
    span = bars.agg(F.max("close_time_ms") - F.min("close_time_ms")).first()[0] + 1
    flush = bars.dropDuplicates(["exchange", "symbol"]).withColumn("close_time_ms", F.lit(10**14)).withColumn("open_time_ms", F.lit(10**14 - 1))
    got = feed(spark, strat, [*parts, flush], bars.schema, hold_ms=span)
    assert sorted((r.symbol, r.ts_ms, r.kind, r.reason) for r in signals_of(got).collect()) == want and want
    assert late_of(got).count() == 0


def test_late_bars_are_reported(spark):
    bars = catalog.bars(spark, SF, 15)
    middle = bars.select(F.percentile_approx("close_time_ms", 0.5)).first()[0]
    old, new = bars.filter(F.col("close_time_ms") <= middle), bars.filter(F.col("close_time_ms") > middle)
    got = feed(spark, Bandtastic(catalog.BT_ACTIVE), [old, new, old], bars.schema)
    assert late_of(got).count() == old.count()
    want = Bandtastic(catalog.BT_ACTIVE).signals(bars).count()
    assert signals_of(got).count() == want


def test_restored_position_and_ledger_on_a_stream(spark):
    bars = catalog.bars(spark, SF, 15)
    symbols = [(r.exchange, r.symbol) for r in bars.select("exchange", "symbol").distinct().collect()]
    # Bought at next to nothing: the first bar reaches the first ROI row.
    given = spark.createDataFrame([(*s, 1e-3, 0) for s in symbols], "exchange string, symbol string, pos_price double, pos_index bigint")
    got = feed(spark, Bandtastic(catalog.BT_ACTIVE), [bars], bars.schema, initial_state=given)
    first = {r.symbol: r for r in signals_of(got).orderBy("ts_ms").collect()[::-1]}
    assert {s for _, s in symbols} == set(first) and all(r.kind == "Exit" for r in first.values())
    plain = feed(spark, Bandtastic(catalog.BT_ACTIVE), [bars], bars.schema)
    want = trade_ledger(Bandtastic(catalog.BT_ACTIVE).signals(bars))
    key = lambda df: sorted(map(str, df.select(sorted(want.columns)).collect()))
    assert key(trades_of(plain)) == key(want)


def test_held_bars_come_out_on_a_timer(spark):
    """The feed falls silent with bars held back: the timer evaluates them."""
    strat = Bandtastic(catalog.BT_ACTIVE)
    bars = catalog.bars(spark, SF, 15).filter("symbol = 'CLICK'")
    want = sorted((r.symbol, r.ts_ms, r.kind, r.reason) for r in strat.signals(bars, chunk_rows=64).collect())
    root = tempfile.mkdtemp(prefix="tw-stream-test-")
    src, out, ckpt = (os.path.join(root, d) for d in ("src", "out", "ckpt"))
    write_in_order(bars, ["close_time_ms"], src, files=2)
    stream = read_in_order(spark, src, bars.schema)
    held = 10**12  # more than the whole feed: without the timer nothing would ever be evaluated
    q = start(stream_signals(stream, strat, hold_ms=held, release_ms=2000), out, ckpt, processingTime="500 milliseconds")
    try:
        for _ in range(120):
            time.sleep(1)
            if os.path.isdir(out) and spark.read.schema("kind string").parquet(out).count() >= len(want):
                break
    finally:
        q.stop()
    assert sorted((r.symbol, r.ts_ms, r.kind, r.reason) for r in spark.read.parquet(out).collect()) == want and want


def test_collapse_across_restarts(spark):
    frames = catalog.good_frames(spark, SF)
    key = lambda df: sorted((r.symbol, r.interval, r.recv_ms, r.frame_no, r.start_ms) for r in df.collect())
    want = key(collapse_updates(frames))
    middle = frames.select(F.percentile_approx("recv_ms", [0.3, 0.6])).first()[0]
    parts = [frames.filter(c) for c in (F.col("recv_ms") <= middle[0], (F.col("recv_ms") > middle[0]) & (F.col("recv_ms") <= middle[1]), F.col("recv_ms") > middle[1])]
    root = tempfile.mkdtemp(prefix="tw-stream-test-")
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(os.path.join(root, "src", f"part{i}"))
        stream = spark.readStream.schema(frames.schema).option("recursiveFileLookup", "true").parquet(os.path.join(root, "src"))
        run_to_end(stream_collapse(stream), os.path.join(root, "out"), os.path.join(root, "ckpt"))
    assert key(spark.read.parquet(os.path.join(root, "out"))) == want and want


def test_ticks_behind_the_watermark_are_counted_and_repaired(spark):
    # Half an hour of ticks: Spark drops a row behind the watermark of two
    # micro-batches before, so a batch must be shorter than the feed's lag.
    sf, begin = tempfile.mkdtemp(prefix="tw-stream-test-"), 1_700_000_100_000
    rows = [(i, begin + i * 1_800, "ab"[i % 2], float(i % 11) if i % 5 else None) for i in range(1000)]
    made = spark.createDataFrame(rows, "event_id bigint, at bigint, event_type string, value double")
    made.withColumn("ts", F.expr("cast(timestamp_millis(at) as timestamp_ntz)")).drop("at").write.parquet(os.path.join(sf, "events.parquet"))
    ticks = catalog.events(spark, sf)
    got = run_to_end(sb.stream_bars(catalog.tick_stream(spark, sf), 15, "1 second"))
    late = sb.late_ticks(ticks, got, 15)
    counted, held = late.agg(F.sum("late")).first()[0], got.agg(F.sum("trades_count")).first()[0]
    assert counted > 0 and counted + held == event_ticks(ticks).count()
    key = lambda df: sorted((r.symbol, r.open_time_ms, r.open, r.close, r.trades_count, round(r.volume, 6)) for r in df.collect())
    assert key(sb.corrected_bars(ticks, got, 15, late)) == key(resample_bars(ticks, 15))


def batches_of(checkpoint: str) -> int:
    return len([f for f in os.listdir(os.path.join(checkpoint, "commits")) if f.isdigit()])


def test_replay_has_a_bounded_number_of_micro_batches(spark):
    """Thrice as many files as a replay has micro-batches, and a few more; keyed streams take ``most`` files at a time."""
    files = 3 * BATCHES + 4
    rows = spark.range(10 * files).withColumnRenamed("id", "at")
    root = tempfile.mkdtemp(prefix="tw-stream-test-")
    src = write_in_order(rows, ["at"], os.path.join(root, "src"), files=files)
    for name, most, want in (("all", None, 10), ("keyed", 3, 14)):
        out, ckpt = os.path.join(root, f"{name}-out"), os.path.join(root, f"{name}-ckpt")
        got = run_to_end(read_in_order(spark, src, rows.schema, most=most), out, ckpt)
        assert sorted(r.at for r in got.collect()) == list(range(10 * files))
        assert batches_of(ckpt) == want


def test_replayed_ticks_are_bars_whatever_the_batches(spark):
    """Many files in a micro-batch: in order, and under a watermark too short for the feed, the bars are those of the batch form."""
    begin = 1_700_000_000_000
    ticks = [(i, begin + i * 2_000, ("a", "b", None)[i % 3] if i % 7 else "a", float(i % 11) if i % 5 else None) for i in range(2000)]
    columns = "event_id bigint, at bigint, event_type string, value double"
    events = spark.createDataFrame(ticks, columns).withColumn("ts", F.expr("cast(timestamp_millis(at) as timestamp_ntz)")).drop("at")
    beat = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    fed = events.unionByName(beat, allowMissingColumns=True).withColumn("_arrival", F.unix_millis(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(catalog.LAG_MS)))
    src = write_in_order(fed, ["_arrival"], files=2 * BATCHES + 2)
    key = lambda df: sorted((r.symbol, r.open_time_ms, r.open, r.close, r.trades_count, round(r.volume, 6)) for r in df.collect())
    want = key(resample_bars(events, 15))
    assert key(run_to_end(sb.stream_bars(read_in_order(spark, src, fed.schema), 15, catalog.DELAY))) == want
    got = run_to_end(sb.stream_bars(read_in_order(spark, src, fed.schema), 15, "1 second"))
    assert sb.late_ticks(events, got, 15).count() > 0
    assert key(sb.corrected_bars(events, got, 15)) == want


def test_state_partitions_follow_the_rows_of_a_micro_batch(spark):
    """A session with many shuffle partitions: a micro-batch commits no more of them than its rows need."""
    root, own = tempfile.mkdtemp(prefix="tw-stream-test-"), spark.conf.get("spark.sql.shuffle.partitions")
    wave, many = spark.sparkContext.defaultParallelism, 500
    begin = 1_700_000_000_000
    ticks = [(i, begin + i * 20_000, "abc"[i % 3], float(i % 11)) for i in range(2000)]
    events = spark.createDataFrame(ticks, "event_id bigint, at bigint, event_type string, value double")
    events = events.withColumn("ts", F.expr("cast(timestamp_millis(at) as timestamp_ntz)")).drop("at").coalesce(1)
    key = lambda df: sorted((r.symbol, r.open_time_ms, r.open, r.close, r.trades_count, round(r.volume, 6)) for r in df.collect())
    want = key(resample_bars(events, 15))
    sf, ckpt = os.path.join(root, "sf"), os.path.join(root, "ckpt")
    events.write.parquet(os.path.join(sf, "events.parquet"))
    spark.conf.set("spark.sql.shuffle.partitions", many)
    try:
        src, schema = catalog.tick_feed(spark, sf)
        got = replay(spark, src, schema, lambda rows: sb.stream_bars(rows, 15, catalog.DELAY), checkpoint=ckpt)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(many)
        assert key(got) == want and key(catalog.q_stream_bars_late(spark, sf)) == want
        # More files in a micro-batch: more partitions, up to the session's.
        big = os.path.join(root, "big")
        spark.range(0, 3 * wave * BATCHES, 1, 3 * wave * BATCHES).write.parquet(big)
        assert state_partitions(spark, big) == -(-3 * wave * FILE_ROWS // STATE_ROWS) > wave
        spark.conf.set("spark.sql.shuffle.partitions", 2)
        assert state_partitions(spark, big) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
    kept = [d for d in os.listdir(os.path.join(ckpt, "state", "0")) if d.isdigit()]
    assert len(kept) == wave

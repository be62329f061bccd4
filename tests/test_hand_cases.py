"""Hand-worked cases (fixture table of the blueprint), one per rule."""

import pytest
from pyspark.sql import functions as F

from tickwise.functions import intervals as iv
from tickwise.functions import numbers as nb
from tickwise.functions import time as tm
from tickwise.operators.fold import sequential_fold
from tickwise.strategies.bandtastic import Bandtastic
from tickwise.strategies.mtf_macd import MultiTimeFrameMacd

# A frame of the wire schema; all values are ours.
SAMPLE = ('{"stream":"acmeusd@kline_1m","data":{"e":"kline","E":1700000041000,"s":"ACMEUSD","k":{"t":1700000040000,'
          '"T":1700000099999,"s":"ACMEUSD","i":"1m","f":11,"L":52,"o":"12.50000000",'
          '"c":"12.75000000","h":"13.00000000","l":"12.25000000","v":"7.50000000","n":42,"x":false,'
          '"q":"95.0","V":"3.5","Q":"44.0","B":"0"}}}')


def test_labels(spark):
    row = spark.range(1).select(
        tm.label_utc8(F.lit(1700000040000)).alias("label"),
        tm.archive_file_name(F.lit(1700000041000), 28800).alias("file"),
        tm.alert_time(F.lit(1700000041000)).alias("alert"),
        iv.stream_name(F.lit("ACMEUSD"), F.lit("1m")).alias("stream"),
    ).first()
    assert row.label == "20231115-06:14"
    assert row.file == "kline_20231115-0000.zst"
    assert row.alert == "20231115-06:14.01"
    assert row.stream == "acmeusd@kline_1m"


@pytest.mark.parametrize("text,value", [
    ("12.50000000", 12.5), ("abc", 0.0), ("1.0d", 0.0), (" 1.5 ", 0.0), ("0x1p3", 0.0), ("-2e3", -2000.0),
    (".5", 0.5), ("5.", 5.0), ("", 0.0),
])
def test_parse_price(spark, text, value):
    got = spark.createDataFrame([(text,)], "t string").select(nb.parse_price("t").alias("p")).first().p
    assert got == value


def test_intervals(spark):
    rows = spark.createDataFrame([(n,) for n in ["1h", "60m", "4h", "240m", "15m", "1d", "weird"]], "i string").select(
        "i", iv.interval_minutes("i").alias("m"), iv.canonical_interval("i").alias("c")).collect()
    got = {r.i: (r.m, r.c) for r in rows}
    assert got["1h"] == (60, "60m") and got["60m"] == (60, "60m") and got["4h"] == (240, "240m")
    assert got["1d"] == (1440, "1440m") and got["weird"] == (None, "weird")


def test_decode_rejects(spark):
    from tickwise.sources.frames import decode_all

    cases = [
        SAMPLE,
        '{"result":null,"id":1}',
        SAMPLE.replace(',"n":42', ""),
        SAMPLE.replace('"o":"12.50000000"', '"o":1.5'),
        "not json",
    ]
    raw = spark.createDataFrame([(i, 0, t) for i, t in enumerate(cases)], "recv_ms bigint, frame_no int, text string")
    got = {r.recv_ms: r.reject_reason for r in decode_all(raw).collect()}
    assert got[0] is None
    assert got[1] == "missing:stream"
    assert got[2] == "missing:data.k.n"
    assert got[3] == "type:data.k.o"
    assert got[4] == "not_json"


def _bt(**kw):
    return Bandtastic(**kw)


def test_bandtastic_roi_rows():
    s = _bt()
    # row: (bar_index, close, high100, buy, sell); entry at bar 1 price 100
    enter = (1, 100.0, 100.0, True, False)
    sig = sequential_fold([enter, (2, 116.3, 116.3, False, False)], s)
    assert sig[1][1][2] == "Roi" and sig[1][1][3] == 0
    sig = sequential_fold([enter, (2, 100.0, 100.0, False, False), (3, 100.0, 100.0, False, False),
                           (4, 100.0, 100.0, False, False), (5, 110.0, 110.0, False, False)], s)
    assert sig[-1][1][2] == "Roi" and sig[-1][1][3] == 69
    sig = sequential_fold([enter, (2, 100.0, 100.0, False, False), (3, 100.0, 100.0, False, False),
                           (4, 110.0, 110.0, False, False)], s)
    assert len(sig) == 1  # too early for the 69-minute row


def test_bandtastic_stop_and_trailing():
    s = _bt()
    sig = sequential_fold([(1, 100.0, 100.0, True, False), (2, 60.0, 100.0, False, False)], s)
    assert sig[-1][1][2] == "TrailingStop"  # overrides the stop loss
    s_off = _bt(trailing_stop=False)
    sig = sequential_fold([(1, 100.0, 100.0, True, False), (2, 65.0, 100.0, False, False)], s_off)
    assert sig[-1][1][2] == "StopLoss"
    sig = sequential_fold([(1, 100.0, 120.0, True, False), (2, 101.0, 120.0, False, False)], s)
    assert sig[-1][1][2] == "TrailingStop"  # stale high from before the entry
    sig = sequential_fold([(1, 100.0, 100.0, True, False), (2, 100.0, 100.0, False, True)], s)
    assert sig[-1][1][2] == "StopProfit"


def test_macd_arm_and_trail():
    s = MultiTimeFrameMacd()
    # row: (bar_index, close, long_entry, short_entry, long_exit, short_exit)
    sig = sequential_fold([(1, 100.0, True, False, False, False), (2, 101.0, False, False, False, False),
                           (3, 100.4, False, False, False, False)], s)
    assert [x[1][0] for x in sig] == ["Enter", "Exit"] and sig[1][0] == 2 and sig[1][1][2] == "TrailingStop"
    sig = sequential_fold([(1, 100.0, False, True, False, False), (2, 98.9, False, False, False, False),
                           (3, 100.6, False, False, False, False)], s)
    assert sig[0][1][1] == "Short" and sig[1][0] == 2 and sig[1][1][2] == "TrailingStop"


def test_ledger_guard_and_roi(spark):
    from tickwise.operators.ledger import trade_ledger

    sig = spark.createDataFrame([
        ("x", "A", 1, 1, "Enter", "Long", None, None, None, 100.0),
        ("x", "A", 2, 2, "Enter", "Long", None, None, None, 105.0),
        ("x", "A", 3, 3, "Exit", None, "StopProfit", None, None, 110.0),
        ("x", "A", 4, 4, "Exit", None, "StopLoss", None, None, 90.0),
        ("x", "B", 1, 1, "Enter", "Short", None, None, None, 100.0),
        ("x", "B", 2, 2, "Exit", None, "StopLoss", None, None, 90.0),
    ], "exchange string, symbol string, seq bigint, ts_ms bigint, kind string, direction string, reason string, "
       "roi_minutes bigint, roi_pct double, price double")
    rows = trade_ledger(sig, chunk_rows=2).orderBy("symbol", "event").collect()
    a = [r for r in rows if r.symbol == "A"]
    assert len(a) == 2
    close = [r for r in a if r.event == "close"][0]
    assert close.enter_price == 100.0 and close.exit_price == 110.0 and close.direction == "LongClose"
    assert abs(close.roi - 4.0) < 1e-9
    b_close = [r for r in rows if r.symbol == "B" and r.event == "close"][0]
    assert abs(b_close.roi - 4.0) < 1e-9 and b_close.direction == "ShortClose"
    lit = trade_ledger(sig, literal_roi=True).filter("event = 'close'").collect()
    assert all(r.roi is None for r in lit)


def test_collapse_updates(spark):
    from tickwise.sources.frames import collapse_updates

    starts = [1, 1, 2, 2, 1, 3]
    df = spark.createDataFrame([(i + 1, 0, "S", "1m", s) for i, s in enumerate(starts)],
                               "recv_ms bigint, frame_no int, symbol string, interval string, start_ms bigint")
    kept = sorted(r.recv_ms for r in collapse_updates(df, chunk_rows=2).collect())
    assert kept == [2, 4, 5]


def test_fan_out(spark):
    from tickwise.sinks.alerts import fan_out

    alerts = spark.createDataFrame([("trade", "{}")], "kind string, body string")
    assert fan_out(alerts, ["http://a", "http://b"]).count() == 2

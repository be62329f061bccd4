"""Registered queries: one Spark builder and (where SQL can say it) one
DuckDB oracle per operator of the blueprint inventory.

Every query reads the driver's tables (bars come from ``events``), runs on
the whole table, and rounds doubles to 6 places on both sides so the value
hashes compare the same numbers.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import intervals as iv
from ..functions import numbers as nb
from ..functions import time as tm
from ..operators.ledger import trade_ledger, trade_roi
from ..operators.series import DEFAULT_CHUNK_ROWS
from ..sources.bars import event_fault, resample_bars, sql_event_bars
from ..sources.tables import read_table
from ..strategies.bandtastic import Bandtastic, BandtasticParams
from ..strategies.mtf_macd import MacdParams, MultiTimeFrameMacd
from . import oracle as oq

CHUNK = DEFAULT_CHUNK_ROWS
ROUND = 6

# Parameter set under which the Bollinger-band strategy trades on the
# synthetic events (the runner's MFI gate almost never opens there).
ACTIVE_BANDTASTIC = {"buy_rsi_enabled": False, "buy_mfi_enabled": False}


# Parameter set with the RSI and MFI gates on, wide enough to open here.
GATED_BANDTASTIC = {"buy_rsi_threshold": 60.0, "buy_mfi_threshold": 60.0}

# Parameter set under which every exit rule fires: no trailing stop and a rare
# sell signal leave room for the stop loss and for all rows of the ROI table.
EXITS_BANDTASTIC = {
    "buy_rsi_threshold": 100.0, "buy_mfi_threshold": 100.0, "trailing_stop": False, "sell_trigger": "sell-bb_upper4",
    "sell_mfi_enabled": False, "sell_ema_enabled": False, "stoploss": -0.8,
    "min_roi": [[0, 9.0], [30, 5.0], [60, 2.5], [90, 0.5]],
}

#: Chunk of the queries that check results over many chunks.
SMALL_CHUNK = 64


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    def wrap(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return wrap


def rnd(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, ROUND)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def bars(spark: SparkSession, sf: str, minutes=15) -> DataFrame:
    return resample_bars(events(spark, sf), minutes)


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip().lstrip(',')}\n{select}"


BAR_SQL15 = sql_event_bars(15)
BT = BandtasticParams()
BT_ACTIVE = BandtasticParams(**ACTIVE_BANDTASTIC)
BT_GATED = BandtasticParams(**GATED_BANDTASTIC)
BT_EXITS = BandtasticParams(**EXITS_BANDTASTIC)
MP = MacdParams()

_TICK_FAULT_SQL = "CASE WHEN ts IS NULL THEN 'no_time' WHEN value IS NULL THEN 'no_price' WHEN event_type IS NULL THEN 'no_symbol' END"


@query("tick_rejects", f"SELECT coalesce({_TICK_FAULT_SQL}, 'tick') AS outcome, count(*) AS n FROM events GROUP BY ALL")
def q_tick_rejects(spark, sf):
    """How many events become ticks, and why the others don't."""
    outcome = F.coalesce(event_fault(), F.lit("tick")).alias("outcome")
    return events(spark, sf).groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


# ---- X1 / scalars on bars ------------------------------------------------------------------

@query("resample_bars", f"SELECT exchange, symbol, open_time_ms, close_time_ms, open_time_h, interval, open, high, low, close, round(volume, {ROUND}) AS volume, trades_count FROM ({BAR_SQL15})")
def q_resample_bars(spark, sf):
    b = bars(spark, sf)
    return b.select(*[rnd(c).alias(c) if c == "volume" else F.col(c) for c in b.columns])


@query("label_utc8", f"SELECT symbol, open_time_ms, {tm.sql_label_utc8('open_time_ms')} AS open_time_h FROM ({BAR_SQL15})")
def q_label(spark, sf):
    return bars(spark, sf).select("symbol", "open_time_ms", tm.label_utc8("open_time_ms").alias("open_time_h"))


@query("archive_period", f"SELECT symbol, close_time_ms, {tm.sql_archive_period('close_time_ms', 28800)} AS period, 'kline_' || {tm.sql_archive_period('close_time_ms', 28800)} || '.zst' AS file_name FROM ({BAR_SQL15})")
def q_archive_period(spark, sf):
    return bars(spark, sf).select(
        "symbol", "close_time_ms", tm.archive_period("close_time_ms", 28800).alias("period"),
        tm.archive_file_name("close_time_ms", 28800).alias("file_name"),
    )


@query("alert_time", f"SELECT symbol, close_time_ms, {tm.sql_alert_time('close_time_ms')} AS alert_time FROM ({BAR_SQL15})")
def q_alert_time(spark, sf):
    return bars(spark, sf).select("symbol", "close_time_ms", tm.alert_time("close_time_ms").alias("alert_time"))


@query("stream_name", f"SELECT symbol, open_time_ms, lower(symbol) || '@kline_' || interval AS stream_name FROM ({BAR_SQL15})")
def q_stream_name(spark, sf):
    return bars(spark, sf).select("symbol", "open_time_ms", iv.stream_name("symbol", "interval").alias("stream_name"))


@query("hlc3", f"SELECT symbol, open_time_ms, round((high + low + close) / 3.0, {ROUND}) AS hlc3 FROM ({BAR_SQL15})")
def q_hlc3(spark, sf):
    return bars(spark, sf).select("symbol", "open_time_ms", rnd(nb.hlc3()).alias("hlc3"))


_MULTI = f"{sql_event_bars(15)} UNION ALL {sql_event_bars(60)} UNION ALL {sql_event_bars(240)}"


@query("interval_normalize", f"SELECT symbol, open_time_ms, interval, {iv.sql_interval_minutes('interval')} AS minutes, {iv.sql_canonical_interval('interval')} AS interval_c FROM ({_MULTI})")
def q_interval_normalize(spark, sf):
    return bars(spark, sf, [15, 60, 240]).select(
        "symbol", "open_time_ms", "interval", iv.interval_minutes("interval").alias("minutes"),
        iv.canonical_interval("interval").alias("interval_c"),
    )


_PRICE_TEXTS_SQL = """
SELECT event_id, CAST(value AS VARCHAR) AS t_plain, CAST(value AS VARCHAR) || 'd' AS t_suffix,
       ' ' || CAST(value AS VARCHAR) AS t_blank, props AS t_json, '-' || CAST(event_id AS VARCHAR) || 'e2' AS t_exp
FROM events"""


@query("parse_price", f"SELECT event_id, round({nb.sql_parse_price('t_plain')}, {ROUND}) AS p_plain, {nb.sql_parse_price('t_suffix')} AS p_suffix, {nb.sql_parse_price('t_blank')} AS p_blank, {nb.sql_parse_price('t_json')} AS p_json, {nb.sql_parse_price('t_exp')} AS p_exp FROM ({_PRICE_TEXTS_SQL})")
def q_parse_price(spark, sf):
    e = events(spark, sf)
    v = F.col("value").cast("string")
    t = e.select(
        "event_id", v.alias("t_plain"), F.concat(v, F.lit("d")).alias("t_suffix"), F.concat(F.lit(" "), v).alias("t_blank"),
        F.col("props").alias("t_json"), F.concat(F.lit("-"), F.col("event_id").cast("string"), F.lit("e2")).alias("t_exp"),
    )
    return t.select(
        "event_id", rnd(nb.parse_price("t_plain")).alias("p_plain"), nb.parse_price("t_suffix").alias("p_suffix"),
        nb.parse_price("t_blank").alias("p_blank"), nb.parse_price("t_json").alias("p_json"), nb.parse_price("t_exp").alias("p_exp"),
    )


# Trade-return inputs: every event opens a trade at its value and closes it at the next event's value of the same type.
_ROI_INPUT_SQL = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Long' WHEN 1 THEN 'Short' ELSE 'LongClose' END AS direction,
       value AS enter_price, value * 1.1 - 1.0 AS exit_price FROM events"""


@query("trade_roi", f"SELECT event_id, direction, round(CASE WHEN direction = 'Long' THEN (exit_price - enter_price) / NULLIF(enter_price, 0.0) * 100.0 - 0.06 * 100.0 WHEN direction = 'Short' THEN (enter_price - exit_price) / NULLIF(enter_price, 0.0) * 100.0 - 0.06 * 100.0 END, {ROUND}) AS roi FROM ({_ROI_INPUT_SQL})")
def q_trade_roi(spark, sf):
    e = events(spark, sf)
    d = F.when(F.col("event_id") % 3 == 0, "Long").when(F.col("event_id") % 3 == 1, "Short").otherwise("LongClose")
    t = e.select("event_id", d.alias("direction"), F.col("value").alias("enter_price"), (F.col("value") * 1.1 - 1.0).alias("exit_price"))
    return t.select("event_id", "direction", rnd(trade_roi(F.col("direction"), F.col("enter_price"), F.col("exit_price"), F.lit(0.06))).alias("roi"))


# ---- bounded windows ---------------------------------------------------------------------

def bt_features(spark, sf, params=None) -> DataFrame:
    strat = Bandtastic(params or BT)
    return strat.features(bars(spark, sf, strat.params.bar_minutes), CHUNK)


def bt_windows(spark, sf) -> DataFrame:
    """The bounded-window columns only: nothing of the recurrences is computed."""
    return Bandtastic(BT).windows(bars(spark, sf, BT.bar_minutes), CHUNK)


def _bt_sql(select: str, p: BandtasticParams = BT) -> str:
    return with_(oq.bandtastic_feature_ctes(p), select)


_BANDS = ", ".join(f"round(bb_lower{k}, {ROUND}) AS bb_lower{k}, round(bb_upper{k}, {ROUND}) AS bb_upper{k}" for k in (1, 2, 3, 4))


@query("bollinger", _bt_sql(f"SELECT exchange, symbol, seq, round(bb_mid, {ROUND}) AS bb_mid, {_BANDS} FROM feat"))
def q_bollinger(spark, sf):
    f = bt_windows(spark, sf)
    return f.select("exchange", "symbol", "seq", rnd("bb_mid").alias("bb_mid"),
                    *[rnd(f"bb_{s}{k}").alias(f"bb_{s}{k}") for k in (1, 2, 3, 4) for s in ("lower", "upper")])


@query("mfi", _bt_sql(f"SELECT exchange, symbol, seq, round(mfi, {ROUND}) AS mfi FROM feat"))
def q_mfi(spark, sf):
    return bt_windows(spark, sf).select("exchange", "symbol", "seq", rnd("mfi").alias("mfi"))


@query("rolling_high", _bt_sql("SELECT exchange, symbol, seq, high100 FROM feat"))
def q_rolling_high(spark, sf):
    return bt_windows(spark, sf).select("exchange", "symbol", "seq", "high100")


@query("bar_index", with_(oq.macd_feature_ctes(MP), "SELECT exchange, symbol, seq, interval_c, bar_index FROM feat"))
def q_bar_index(spark, sf):
    strat = MultiTimeFrameMacd(MP)
    f = strat.merged(strat.accepted(bars(spark, sf, [60, 240])), CHUNK)
    return f.select("exchange", "symbol", "seq", "interval_c", F.col("bar_index").cast("bigint").alias("bar_index"))


@query("interval_guard", f"""SELECT exchange, symbol, open_time_ms, interval,
  {iv.sql_canonical_interval('interval')} = '15m' AS bandtastic_accepts,
  {iv.sql_canonical_interval('interval')} IN ('60m', '240m') AS macd_accepts FROM ({_MULTI})""")
def q_interval_guard(spark, sf):
    b = bars(spark, sf, [15, 60, 240])
    ci = iv.canonical_interval("interval")
    return b.select("exchange", "symbol", "open_time_ms", "interval", (ci == "15m").alias("bandtastic_accepts"),
                    ci.isin("60m", "240m").alias("macd_accepts"))


# ---- recurrences ---------------------------------------------------------------------------

@query("ema", _bt_sql(f"SELECT exchange, symbol, seq, round(buy_fast_ema, {ROUND}) AS buy_fast_ema, round(buy_slow_ema, {ROUND}) AS buy_slow_ema, round(sell_fast_ema, {ROUND}) AS sell_fast_ema, round(sell_slow_ema, {ROUND}) AS sell_slow_ema FROM feat"))
def q_ema(spark, sf):
    f = bt_features(spark, sf)
    return f.select("exchange", "symbol", "seq", *[rnd(c).alias(c) for c in ("buy_fast_ema", "buy_slow_ema", "sell_fast_ema", "sell_slow_ema")])


@query("rsi", _bt_sql(f"SELECT exchange, symbol, seq, round(rsi, {ROUND}) AS rsi FROM feat"))
def q_rsi(spark, sf):
    return bt_features(spark, sf).select("exchange", "symbol", "seq", rnd("rsi").alias("rsi"))


@query("macd", with_(oq.macd_feature_ctes(MP), f"SELECT exchange, symbol, interval_c, tf_seq, round(macd, {ROUND}) AS macd, round(signal, {ROUND}) AS signal, round(hist, {ROUND}) AS hist FROM mt"))
def q_macd(spark, sf):
    m = MultiTimeFrameMacd(MP).timeframe_macd(bars(spark, sf, [60, 240]), CHUNK)
    return m.select("exchange", "symbol", "interval_c", "tf_seq", rnd("macd").alias("macd"), rnd("signal").alias("signal"), rnd("hist").alias("hist"))


# ---- predicates -----------------------------------------------------------------------------

@query("bandtastic_buy", _bt_sql("SELECT exchange, symbol, seq, buy FROM feat"))
def q_buy(spark, sf):
    return bt_features(spark, sf).select("exchange", "symbol", "seq", "buy")


@query("bandtastic_sell", _bt_sql("SELECT exchange, symbol, seq, sell FROM feat"))
def q_sell(spark, sf):
    return bt_features(spark, sf).select("exchange", "symbol", "seq", "sell")


def macd_features(spark, sf, params=None) -> DataFrame:
    return MultiTimeFrameMacd(params or MP).features(bars(spark, sf, [60, 240]), CHUNK)


_MACD_SQL = lambda sel, p=MP: with_(oq.macd_feature_ctes(p), sel)


@query("macd_trend", _MACD_SQL("SELECT exchange, symbol, seq, long_trend, short_trend FROM feat"))
def q_macd_trend(spark, sf):
    return macd_features(spark, sf).select("exchange", "symbol", "seq", "long_trend", "short_trend")


@query("macd_entries", _MACD_SQL("SELECT exchange, symbol, seq, long_entry, short_entry FROM feat"))
def q_macd_entries(spark, sf):
    return macd_features(spark, sf).select("exchange", "symbol", "seq", "long_entry", "short_entry")


@query("macd_exits", _MACD_SQL("SELECT exchange, symbol, seq, long_exit, short_exit FROM feat"))
def q_macd_exits(spark, sf):
    return macd_features(spark, sf).select("exchange", "symbol", "seq", "long_exit", "short_exit")


_ASOF_COLS = ["macd_1h", "signal_1h", "hist_1h", "macd_4h", "signal_4h", "hist_4h"]


@query("macd_asof", _MACD_SQL(f"SELECT exchange, symbol, seq, close_time_ms, interval_c, {', '.join(f'round({c}, {ROUND}) AS {c}' for c in _ASOF_COLS)} FROM feat"))
def q_macd_asof(spark, sf):
    f = macd_features(spark, sf)
    return f.select("exchange", "symbol", "seq", "close_time_ms", "interval_c", *[rnd(c).alias(c) for c in _ASOF_COLS])


# ---- state machines --------------------------------------------------------------------------

SIG_COLS = ["exchange", "symbol", "seq", "ts_ms", "kind", "direction", "reason", "roi_minutes", "roi_pct", "price"]
SIG_SELECT = "SELECT " + ", ".join(SIG_COLS) + " FROM sig"


@query("bandtastic_signals", with_(oq.bandtastic_signal_ctes(BT_GATED), SIG_SELECT))
def q_bandtastic_signals(spark, sf):
    return Bandtastic(BT_GATED).signals(bars(spark, sf, 15), CHUNK).select(*SIG_COLS)


@query("bandtastic_exit_rules", with_(oq.bandtastic_signal_ctes(BT_EXITS), SIG_SELECT))
def q_bandtastic_exit_rules(spark, sf):
    """Every exit reason and ROI row, over many chunks."""
    return Bandtastic(json.dumps(EXITS_BANDTASTIC)).signals(bars(spark, sf, 15), SMALL_CHUNK).select(*SIG_COLS)


@query("bandtastic_signals_chunked", with_(oq.bandtastic_signal_ctes(BT_ACTIVE), SIG_SELECT))
def q_bandtastic_signals_chunked(spark, sf):
    return Bandtastic(BT_ACTIVE).signals(bars(spark, sf, 15), SMALL_CHUNK).select(*SIG_COLS)


@query("macd_signals_chunked", with_(oq.macd_signal_ctes(MP), SIG_SELECT))
def q_macd_signals_chunked(spark, sf):
    return MultiTimeFrameMacd(MP).signals(bars(spark, sf, [60, 240]), SMALL_CHUNK).select(*SIG_COLS)


@query("strategy_params", with_(oq.bandtastic_signal_ctes(BT_ACTIVE), SIG_SELECT))
def q_strategy_params(spark, sf):
    s = Bandtastic(json.dumps(ACTIVE_BANDTASTIC))
    return s.signals(bars(spark, sf, 15), CHUNK).select(*SIG_COLS)


@query("per_symbol_state", with_(oq.bandtastic_signal_ctes(BT_ACTIVE), "SELECT exchange, symbol, kind, coalesce(reason, 'None') AS reason, count(*) AS n FROM sig GROUP BY ALL"))
def q_per_symbol_state(spark, sf):
    s = Bandtastic(BT_ACTIVE).signals(bars(spark, sf, 15), CHUNK)
    return s.groupBy("exchange", "symbol", "kind", F.coalesce("reason", F.lit("None")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("macd_signals", with_(oq.macd_signal_ctes(MP), SIG_SELECT))
def q_macd_signals(spark, sf):
    return MultiTimeFrameMacd(MP).signals(bars(spark, sf, [60, 240]), CHUNK).select(*SIG_COLS)


# Raw signal stream for the ledger: one signal per event, keyed by user, with
# repeated Enters and Exits so the ledger's guards are exercised.
_RAW_SIGNALS_SQL = """
SELECT 'synthetic' AS exchange, 'U' || CAST(user_id AS VARCHAR) AS symbol, event_id AS seq, (epoch_us(ts) // 1000) AS ts_ms,
       CASE WHEN value >= 25.0 THEN 'Enter' ELSE 'Exit' END AS kind,
       CASE WHEN value >= 25.0 THEN (CASE WHEN event_id % 2 = 0 THEN 'Long' ELSE 'Short' END) END AS direction,
       CASE WHEN value >= 25.0 THEN NULL WHEN value < 5.0 THEN 'StopLoss' ELSE 'StopProfit' END AS reason,
       CAST(NULL AS BIGINT) AS roi_minutes, CAST(NULL AS DOUBLE) AS roi_pct, value AS price
FROM events WHERE ts IS NOT NULL AND value IS NOT NULL AND user_id IS NOT NULL"""


def raw_signals(spark, sf) -> DataFrame:
    e = events(spark, sf).filter(F.col("ts").isNotNull() & F.col("value").isNotNull() & F.col("user_id").isNotNull())
    enter = F.col("value") >= 25.0
    return e.select(
        F.lit("synthetic").alias("exchange"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_id").alias("seq"), tm.epoch_ms("ts").alias("ts_ms"),
        F.when(enter, "Enter").otherwise("Exit").alias("kind"),
        F.when(enter, F.when(F.col("event_id") % 2 == 0, "Long").otherwise("Short")).alias("direction"),
        F.when(enter, F.lit(None)).when(F.col("value") < 5.0, "StopLoss").otherwise("StopProfit").alias("reason"),
        F.lit(None).cast("bigint").alias("roi_minutes"), F.lit(None).cast("double").alias("roi_pct"), F.col("value").alias("price"),
    )


TRADE_SELECT = (
    "SELECT exchange, symbol, event, direction, enter_price, exit_price, enter_time, exit_time, exit_reason, "
    f"roi_minutes, roi_pct, round(roi, {ROUND}) AS roi, fee FROM trades"
)


@query("trade_ledger", with_(f"raw AS ({_RAW_SIGNALS_SQL})" + oq.ledger_select("raw"), TRADE_SELECT))
def q_trade_ledger(spark, sf):
    t = trade_ledger(raw_signals(spark, sf), chunk_rows=CHUNK)
    return t.withColumn("roi", rnd("roi"))


@query("macd_trades", with_(oq.macd_signal_ctes(MP) + oq.ledger_select("sig"), TRADE_SELECT))
def q_macd_trades(spark, sf):
    sig = MultiTimeFrameMacd(MP).signals(bars(spark, sf, [60, 240]), CHUNK)
    return trade_ledger(sig, chunk_rows=CHUNK).withColumn("roi", rnd("roi"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


# ---- frames (S1, S2, F1, F2, F5, J2, S5, S6) ----------------------------------------------------

from ..sources import frames as fr  # noqa: E402

_FRAMES_SQL = fr.frames_sql(BAR_SQL15)
_DECODED_SQL = fr.decode_sql(_FRAMES_SQL)
_DECODE_COLS = ["recv_ms", "frame_no", "stream", "event_type", "event_time", "symbol", "start_ms", "end_ms", "k_symbol",
                "interval", "trades", "closed", "reject_reason"]
_GOOD = f"SELECT * FROM ({_DECODED_SQL}) d WHERE reject_reason IS NULL"


def raw_frames(spark, sf) -> DataFrame:
    return fr.frames_from_bars(bars(spark, sf))


def good_frames(spark, sf) -> DataFrame:
    return fr.decode_frames(raw_frames(spark, sf))[0]


@query("decode_frames", f"SELECT {', '.join(_DECODE_COLS)} FROM ({_DECODED_SQL}) d")
def q_decode_frames(spark, sf):
    return fr.decode_all(raw_frames(spark, sf)).select(*_DECODE_COLS)


_NORM_SQL = f"""SELECT '{fr.FRAME_EXCHANGE}' AS exchange, symbol, start_ms AS open_time_ms, end_ms AS close_time_ms,
  {tm.sql_label_utc8('start_ms')} AS open_time_h, interval,
  {nb.sql_parse_price("open_text")} AS open, {nb.sql_parse_price("high_text")} AS high,
  {nb.sql_parse_price("low_text")} AS low, {nb.sql_parse_price("close_text")} AS close,
  round({nb.sql_parse_price("volume_text")}, {ROUND}) AS volume, CAST(trades AS BIGINT) AS trades_count
FROM ({_DECODED_SQL}) d WHERE reject_reason IS NULL AND closed"""


@query("normalize_bars", _NORM_SQL)
def q_normalize_bars(spark, sf):
    b = fr.normalize_bars(fr.closed_bars(good_frames(spark, sf)))
    return b.withColumn("volume", rnd("volume"))


@query("closed_bars", f"SELECT recv_ms, frame_no, symbol, interval, start_ms FROM ({_GOOD}) g WHERE closed")
def q_closed_bars(spark, sf):
    return fr.closed_bars(good_frames(spark, sf)).select("recv_ms", "frame_no", "symbol", "interval", "start_ms")


@query("symbol_index", f"SELECT symbol, CAST(row_number() OVER (ORDER BY first_recv, first_no, symbol) AS BIGINT) AS symbol_index FROM (SELECT symbol, arg_min(recv_ms, (recv_ms, frame_no)) AS first_recv, arg_min(frame_no, (recv_ms, frame_no)) AS first_no FROM ({_GOOD}) g GROUP BY symbol) s")
def q_symbol_index(spark, sf):
    return fr.symbol_index(good_frames(spark, sf))


@query("collapse_updates", f"SELECT recv_ms, frame_no, symbol, interval, start_ms, closed FROM (SELECT *, lead(start_ms) OVER (PARTITION BY symbol, interval ORDER BY recv_ms, frame_no) AS next_start FROM ({_GOOD}) g) x WHERE next_start IS NOT NULL AND next_start <> start_ms")
def q_collapse_updates(spark, sf):
    return fr.collapse_updates(good_frames(spark, sf)).select("recv_ms", "frame_no", "symbol", "interval", "start_ms", "closed")


# The subscription list of the live program (pairs of symbol, interval).
SUBSCRIPTIONS = [("btcusdt", "1m"), ("ethusdt", "1m"), ("solusdt", "1m"), ("rayusdt", "15m")]
# Subscription used on the synthetic feed (its symbols are event types).
TEST_SUBSCRIPTIONS = [("click", "15m"), ("view", "15m"), ("error", "1h"), ("btcusdt", "1m")]
_SUBS_VALUES = ", ".join(f"('{s}', '{i}')" for s, i in TEST_SUBSCRIPTIONS)


@query("subscribed_bars", f"SELECT symbol, interval, open_time_ms, close FROM ({sql_event_bars(15)} UNION ALL {sql_event_bars(60)}) b WHERE (lower(symbol), interval) IN (SELECT (s, i) FROM (VALUES {_SUBS_VALUES}) v(s, i))")
def q_subscribed_bars(spark, sf):
    subs = fr.subscription_table(spark, TEST_SUBSCRIPTIONS)
    return fr.subscribed_bars(bars(spark, sf, [15, 60]), subs).select("symbol", "interval", "open_time_ms", "close")


def feed_messages(spark, sf) -> DataFrame:
    """The test feed's messages: every event is one; ``view`` events stand for pings."""
    kind = F.when(F.col("event_type") == "view", "ping").otherwise("text")
    return events(spark, sf).select(kind.alias("kind"), tm.epoch_ms("ts").alias("recv_ts_ms"))


@query("heartbeat_events", "SELECT 'binance' AS source, epoch_us(ts) // 1000 AS recv_ts_ms, '' AS remark FROM events WHERE event_type = 'view' AND ts IS NOT NULL")
def q_heartbeat_events(spark, sf):
    return fr.heartbeat_events(feed_messages(spark, sf))


_ROUTE_SQL = f"""
SELECT 'strategy' AS route, 'kline' AS kind, symbol, end_ms AS ts_ms, CAST(NULL AS VARCHAR) AS detail FROM ({_GOOD}) g WHERE closed
UNION ALL SELECT 'alerts', 'ping', NULL, epoch_us(ts) // 1000, 'binance' FROM events WHERE event_type = 'view' AND ts IS NOT NULL
UNION ALL SELECT 'log', 'error', NULL, recv_ms, 'Parse error: ' || reject_reason FROM ({_DECODED_SQL}) d WHERE reject_reason IS NOT NULL"""


@query("route_messages", _ROUTE_SQL)
def q_route_messages(spark, sf):
    frames, rejects = fr.decode_frames(raw_frames(spark, sf))
    b = fr.normalize_bars(fr.closed_bars(frames))
    return fr.route_messages(b, fr.heartbeat_events(feed_messages(spark, sf)), rejects)


# ---- text, sinks, sanity, plugin ------------------------------------------------------------------

from ..functions.text import encode_bars, encode_trades, sql_trade_text, trade_text  # noqa: E402
from ..operators.sanity import SQL_SANITY_REASON, bar_sanity  # noqa: E402
from ..sinks import alerts as al  # noqa: E402
from ..sinks import archive as ar  # noqa: E402
from ..strategies.base import REGISTRY as STRATEGIES  # noqa: E402
from ..strategies.ema_cross import EmaCrossParams, ema_cross_sql  # noqa: E402

_LEDGER_SQL = f"raw AS ({_RAW_SIGNALS_SQL})" + oq.ledger_select("raw")
_TRADES_ROUNDED = f"SELECT exchange, symbol, event, direction, enter_price, exit_price, enter_time, exit_time, exit_reason, roi_minutes, roi_pct, round(roi, {ROUND}) AS roi, fee FROM trades"


def ledger_trades(spark, sf) -> DataFrame:
    return trade_ledger(raw_signals(spark, sf), chunk_rows=CHUNK).withColumn("roi", rnd("roi"))


@query("trade_text", with_(_LEDGER_SQL + f", tr AS ({_TRADES_ROUNDED})", f"SELECT exchange, symbol, event, enter_time, exit_time, {sql_trade_text()} AS text FROM tr"))
def q_trade_text(spark, sf):
    t = ledger_trades(spark, sf)
    return t.select("exchange", "symbol", "event", "enter_time", "exit_time", trade_text().alias("text"))


_BAR_JSON_SQL = "to_json({'exchange': exchange, 'symbol': symbol, 'open_time_ms': open_time_ms, 'close_time_ms': close_time_ms, 'open_time_h': open_time_h, 'interval': interval, 'open': open, 'high': high, 'low': low, 'close': close, 'volume': round(volume, 6), 'trades_count': trades_count})"


@query("encode_rows", f"SELECT symbol, open_time_ms, CAST({_BAR_JSON_SQL} AS VARCHAR) AS json FROM ({BAR_SQL15})")
def q_encode_rows(spark, sf):
    b = bars(spark, sf).withColumn("volume", rnd("volume"))
    return b.select("symbol", "open_time_ms", encode_bars(b).alias("json"))


@query("archive_bars", f"SELECT symbol, open_time_ms, close, {tm.sql_archive_period('close_time_ms', ar.DEFAULT_ROTATION_S)} AS period FROM ({BAR_SQL15})")
def q_archive_bars(spark, sf):
    path = ar.scratch_path(spark, "archive")
    ar.archive_bars(bars(spark, sf), path)
    return ar.read_archive(spark, path).select("symbol", "open_time_ms", "close", "period")


@query("read_archive", f"SELECT exchange, symbol, open_time_ms, close_time_ms, open_time_h, interval, open, high, low, close, round(volume, {ROUND}) AS volume, trades_count FROM ({BAR_SQL15})")
def q_read_archive(spark, sf):
    """Half the bars archived as flat JSON objects, half in the legacy
    ``[index, {bar}]`` form; both read back."""
    b = bars(spark, sf)
    path = ar.scratch_path(spark, "legacy-archive")
    idx = fr.symbol_index(b.select("symbol", F.col("close_time_ms").alias("recv_ms"), F.lit(0).alias("frame_no")))
    legacy = ar.legacy_lines(b.filter(F.col("trades_count") % 2 == 0).join(idx, "symbol"))
    flat = b.filter(F.col("trades_count") % 2 == 1).select(encode_bars(b).alias("value"))
    legacy.unionByName(flat).write.mode("overwrite").option("compression", "gzip").text(path)
    back = ar.read_archive(spark, path, fmt="json")
    return back.select(*[rnd(c).alias(c) if c == "volume" else F.col(c) for c in ar.BAR_FIELDS])


# Fixed value: the alert URL list of the live program's configuration.
ALERT_URLS = ["http://127.0.0.1:8000/alert/webhook"]
TEST_URLS = ALERT_URLS + ["http://127.0.0.1:8001/alert/webhook"]


def _alert_sql() -> str:
    name = al.DEFAULT_STRATEGY_NAME
    urls = ", ".join(f"('{u}')" for u in TEST_URLS)
    trade_ts = "CASE WHEN event = 'close' THEN exit_time ELSE enter_time END"
    trades = (f"SELECT 'trade' AS kind, symbol, {trade_ts} AS ts_ms, CAST(to_json({{'{al.KEY_TRADE}': {sql_trade_text()}, "
              f"'{al.KEY_TIME}': {tm.sql_alert_time(trade_ts)}, '{al.KEY_SYMBOL}': symbol, '{al.KEY_STRATEGY}': '{name}'}}) AS VARCHAR) AS body FROM tr")
    pings = (f"SELECT 'ping' AS kind, CAST(NULL AS VARCHAR) AS symbol, recv AS ts_ms, CAST(to_json({{'{al.KEY_TIME}': {tm.sql_alert_time('recv')}, "
             f"'{al.KEY_PING}': {{'recv_ts_ms': recv, 'remark': '', 'source': '{fr.PING_SOURCE}'}}, '{al.KEY_STRATEGY}': '{name}'}}) AS VARCHAR) AS body "
             "FROM (SELECT epoch_us(ts) // 1000 AS recv FROM events WHERE event_type = 'view' AND ts IS NOT NULL) p")
    start = (f"SELECT 'start' AS kind, CAST(NULL AS VARCHAR) AS symbol, began AS ts_ms, CAST(to_json({{'{al.KEY_TIME}': began, "
             f"'{al.KEY_MESSAGE}': '{al.START_MESSAGE}', '{al.KEY_STRATEGY}': '{name}'}}) AS VARCHAR) AS body "
             "FROM (SELECT min(epoch_us(ts) // 1000) AS began FROM events) s")
    return with_(_LEDGER_SQL + f", tr AS ({_TRADES_ROUNDED})",
                 f"SELECT a.*, u.url FROM ({trades} UNION ALL {pings} UNION ALL {start}) a CROSS JOIN (VALUES {urls}) u(url)")


@query("alert_payloads", _alert_sql())
def q_alert_payloads(spark, sf):
    """All three payload kinds; evaluation starts with the first event."""
    messages = feed_messages(spark, sf)
    starts = messages.agg(F.min("recv_ts_ms").alias("ts_ms"))
    return al.alert_payloads(ledger_trades(spark, sf), fr.heartbeat_events(messages), TEST_URLS, starts=starts)


_TRADE_JSON_SQL = """'{"exchange":"' || exchange || '","symbol":"' || symbol || '","direction":"' || coalesce(direction, 'None') || '"'
  || ',"enter_position":' || CASE WHEN enter_price IS NULL THEN 'null' ELSE '{"price":' || CAST(enter_price AS VARCHAR) || ',"entry_bar_index":0,"size":1.0}' END
  || ',"exit_position":' || CASE WHEN exit_price IS NULL THEN 'null' ELSE '{"price":' || CAST(exit_price AS VARCHAR) || ',"entry_bar_index":0,"size":1.0}' END
  || ',"enter_time":' || CAST(enter_time AS VARCHAR) || ',"exit_time":' || CAST(exit_time AS VARCHAR)
  || ',"exit_reason":"' || coalesce(exit_reason, 'None') || '"' || ',"roi":' || coalesce(CAST(roi AS VARCHAR), 'null') || ',"fee":' || CAST(fee AS VARCHAR) || '}'"""


@query("encode_trades", with_(_LEDGER_SQL + f", tr AS ({_TRADES_ROUNDED})", f"SELECT exchange, symbol, event, enter_time, exit_time, {_TRADE_JSON_SQL} AS json FROM tr"))
def q_encode_trades(spark, sf):
    return ledger_trades(spark, sf).select("exchange", "symbol", "event", "enter_time", "exit_time", encode_trades().alias("json"))


# Bars with planted faults, chosen by the time slot: every sanity reason occurs.
_FAULTY_SQL = f"""SELECT * REPLACE (
  CASE (open_time_ms // 900000) % 17 WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN NULL WHEN 5 THEN low - 1.0 ELSE open END AS open,
  CASE (open_time_ms // 900000) % 17 WHEN 6 THEN 'inf'::DOUBLE ELSE high END AS high,
  CASE (open_time_ms // 900000) % 17 WHEN 4 THEN high + 1.0 ELSE close END AS close,
  CASE (open_time_ms // 900000) % 17 WHEN 3 THEN -1.0 - volume ELSE volume END AS volume) FROM ({_NORM_SQL}) n"""


def faulty_bars(b: DataFrame) -> DataFrame:
    kind = F.floor(F.col("open_time_ms") / 900000) % 17
    return b.withColumns({
        "open": F.when(kind == 1, float("nan")).when(kind == 2, F.lit(None)).when(kind == 5, F.col("low") - 1.0).otherwise(F.col("open")),
        "high": F.when(kind == 6, float("inf")).otherwise(F.col("high")),
        "close": F.when(kind == 4, F.col("high") + 1.0).otherwise(F.col("close")),
        "volume": F.when(kind == 3, -1.0 - F.col("volume")).otherwise(F.col("volume")),
    })


@query("bar_sanity", f"SELECT symbol, open_time_ms, {SQL_SANITY_REASON} AS reject_reason FROM ({_FAULTY_SQL}) f")
def q_bar_sanity(spark, sf):
    b = faulty_bars(fr.normalize_bars(fr.closed_bars(good_frames(spark, sf))))
    good, bad = bar_sanity(b)
    return good.select("symbol", "open_time_ms", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        bad.select("symbol", "open_time_ms", "reject_reason"))


@query("strategy_plugin", with_(ema_cross_sql(EmaCrossParams(), BAR_SQL15), SIG_SELECT))
def q_strategy_plugin(spark, sf):
    strat = STRATEGIES["ema_cross"]()
    return strat.signals(bars(spark, sf, 15), CHUNK).select(*SIG_COLS)


# ---- line archive, routing, outbox, symbol dictionary (S3, S6, S4, F2) ---------------------------------

from ..sinks import line_archive as la  # noqa: E402
from ..sinks import outbox as ob  # noqa: E402
from ..sinks import router as ro  # noqa: E402
from ..sources.dictionary import grow_dictionary, indexed  # noqa: E402


@query("archive_lines", f"SELECT exchange, symbol, open_time_ms, close_time_ms, open_time_h, interval, open, high, low, close, round(volume, {ROUND}) AS volume, trades_count, {tm.sql_archive_period('close_time_ms', ar.DEFAULT_ROTATION_S)} AS period FROM ({BAR_SQL15})")
def q_archive_lines(spark, sf):
    """Bars as zstd line files, written in two runs, read back."""
    path = ar.scratch_path(spark, "lines")
    b = bars(spark, sf)
    for odd in (0, 1):
        la.archive_lines(b.filter(F.col("trades_count") % 2 == odd), path)
    return la.read_lines(spark, path)[0].withColumn("volume", rnd("volume"))


def mixed_feed(spark, sf) -> DataFrame:
    """One feed of texts and pings."""
    frames = raw_frames(spark, sf).select(F.lit(False).alias("is_ping"), "recv_ms", F.col("frame_no").cast("bigint").alias("frame_no"), "text")
    pings = feed_messages(spark, sf).filter("kind = 'ping'")
    return frames.unionByName(pings.select(F.lit(True).alias("is_ping"), F.col("recv_ts_ms").alias("recv_ms")), allowMissingColumns=True)


@query("routed_stream", _ROUTE_SQL)
def q_routed_stream(spark, sf):
    """Three sinks fed from one read of one stream; every batch is written twice, as after a failure."""
    feed = materialize(mixed_feed(spark, sf))
    stream = read_in_order(spark, write_in_order(feed, ["recv_ms"]), feed.schema)
    path = ar.scratch_path(spark, "routes")

    def twice(batch, number, to):
        for _ in range(2):
            ro.route_batch(batch, number, to)

    ro.route_stream(ro.tagged_messages(stream), path, ar.scratch_path(spark, "routes-checkpoint"), twice).awaitTermination()
    b, h, e = (ro.read_route(spark, path, r) for r in ("strategy", "alerts", "log"))
    return fr.route_messages(b, h, e.withColumnRenamed("reason", "reject_reason"))


@query("alert_outbox", f"SELECT DISTINCT url, sha256(body) AS body_sha256 FROM ({_alert_sql()}) a")
def q_alert_outbox(spark, sf):
    """What senders acknowledged: first one that refuses some payloads for good, then one that takes all that is left."""
    payloads = materialize(q_alert_payloads(spark, sf))
    outbox = ar.scratch_path(spark, "outbox")
    ob.deliver(payloads.filter(F.crc32(F.col("body").cast("binary")) % 3 > 0), outbox, _accept)
    ob.deliver(payloads, outbox, _accept)
    return ob.acknowledged(spark, outbox).select("url", "body_sha256")


def _accept(url: str, body: str) -> None:
    """A sender that takes everything."""


@query("symbol_dictionary", f"SELECT g.symbol, i.symbol_index, count(*) AS frames FROM ({_GOOD}) g JOIN ({REGISTRY['symbol_index'].sql}) i USING (symbol) GROUP BY ALL")
def q_symbol_dictionary(spark, sf):
    """Numbers given over three runs, joined back to all frames."""
    frames = materialize(good_frames(spark, sf))
    path = ar.scratch_path(spark, "symbols")
    first, second = frames.select(F.percentile_approx("recv_ms", [0.001, 0.5])).first()[0]
    at = F.col("recv_ms")
    for part in (at <= first, (at > first) & (at <= second), at > second):
        known = grow_dictionary(frames.filter(part), path)
    return indexed(frames, known).groupBy("symbol", "symbol_index").agg(F.count(F.lit(1)).alias("frames"))


# ---- many settings in one job (U2) -----------------------------------------------------------------

from ..strategies.sweep import sweep  # noqa: E402

#: Five sets of periods with ten sets of rules each.
SWEEP_PERIODS = [
    {}, {"buy_fast_ema_period": 12, "buy_slow_ema_period": 26}, {"bb_period": 30, "mfi_period": 10},
    {"rsi_period": 7, "sell_fast_ema_period": 9, "sell_slow_ema_period": 8}, {"high_period": 50, "rsi_smoothing": "ema"},
]
SWEEP_RULES = [
    ACTIVE_BANDTASTIC, GATED_BANDTASTIC, EXITS_BANDTASTIC, {}, {"buy_rsi_enabled": False, "buy_mfi_threshold": 70.0},
    {"buy_rsi_threshold": 65.0, "buy_mfi_enabled": False, "buy_trigger": "bb_lower2"}, {**ACTIVE_BANDTASTIC, "trailing_stop": False},
    {**ACTIVE_BANDTASTIC, "buy_ema_enabled": False, "buy_trigger": "bb_lower2", "stoploss": -0.1}, {**ACTIVE_BANDTASTIC, "sell_trigger": "sell-bb_upper1", "sell_rsi_enabled": True},
    {**GATED_BANDTASTIC, "trailing_only_offset_is_reached": True, "min_roi": [[0, 1.5], [120, 0.5], [600, 0.0]]},
]
SWEEP = {f"s{i}{j}": {**periods, **rules} for i, periods in enumerate(SWEEP_PERIODS) for j, rules in enumerate(SWEEP_RULES)}


def _sweep_sql() -> str:
    # One oracle per setting, as one run per setting would give.
    one = lambda name, s: f"SELECT '{name}' AS setting, * FROM ({with_(oq.bandtastic_signal_ctes(BandtasticParams.from_json(s)), SIG_SELECT)}) q_{name}"
    return "\nUNION ALL ".join(one(name, s) for name, s in SWEEP.items())


@query("strategy_sweep", _sweep_sql())
def q_strategy_sweep(spark, sf):
    settings = spark.createDataFrame([(n, json.dumps(s)) for n, s in SWEEP.items()], "setting string, params string")
    return sweep(bars(spark, sf, 15), settings, CHUNK).select("setting", *SIG_COLS)


# ---- resumed series (D4) -------------------------------------------------------------------------


def resumed(spark, sf, strategy, widths) -> DataFrame:
    """The signals of three runs, each of which reads its own third of the bars and the snapshot of the one before."""
    # Written once: every run reads its bars several times, and they are made of all events.
    b = materialize(bars(spark, sf, widths))
    first, second = b.select(F.percentile_approx("close_time_ms", [0.3, 0.6])).first()[0]
    at, out, snapshot = F.col("close_time_ms"), None, None
    for part in (at <= first, (at > first) & (at <= second), at > second):
        found, snapshot = strategy.resume(b.filter(part), snapshot, CHUNK)
        out = found if out is None else out.unionByName(found)
    return out.select(*SIG_COLS)


@query("signals_resumed", with_(oq.bandtastic_signal_ctes(BT_GATED), SIG_SELECT))
def q_signals_resumed(spark, sf):
    return resumed(spark, sf, Bandtastic(BT_GATED), 15)


@query("macd_signals_resumed", with_(oq.macd_signal_ctes(MP), SIG_SELECT))
def q_macd_signals_resumed(spark, sf):
    return resumed(spark, sf, MultiTimeFrameMacd(MP), [60, 240])


# ---- streaming (T5) ------------------------------------------------------------------------------

from ..session import materialize  # noqa: E402
from ..streaming import bars as sb  # noqa: E402
from ..streaming.collapse import stream_collapse  # noqa: E402
from ..streaming.replay import KEYED_FILES, read_in_order, replay, write_in_order  # noqa: E402
from ..streaming.stateful import evaluate_stream, signals_of, trades_of  # noqa: E402


def run_stream(spark, bars_df: DataFrame, strategy, shape, initial_state: DataFrame | None = None) -> DataFrame:
    """Replay bars as a file stream, micro-batches in time order,
    through the keyed-state operator; ``shape`` of its rows lands in a parquet
    file sink (shared folder) and is read back."""
    src = write_in_order(materialize(bars_df), ["close_time_ms"])
    return replay(spark, src, bars_df.schema, lambda stream: shape(evaluate_stream(stream, strategy, initial_state=initial_state)), most=KEYED_FILES)


# Fixed values of the tick replay: arrival lags the event by up to LAG_MS; a
# watermark of DELAY covers that, one of SHORT_DELAY does not.
LAG_MS, DELAY, SHORT_DELAY = 20 * 60000, "20 minutes", "1 minute"


def tick_feed(spark, sf) -> tuple[str, StructType]:
    """The events as a feed that is out of order, closed by a heartbeat (a row without a price) a day after the last event: its files and schema."""
    lag = F.pmod(F.xxhash64("event_id"), F.lit(LAG_MS))
    e = events(spark, sf).withColumn("_arrival", tm.epoch_ms("ts") + lag)
    last = events(spark, sf).agg(F.max("ts").alias("last")).select((F.col("last") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    beat = last.withColumn("_arrival", tm.epoch_ms("ts"))
    fed = e.unionByName(beat, allowMissingColumns=True)
    return write_in_order(materialize(fed), ["_arrival"]), fed.schema


def tick_stream(spark, sf) -> DataFrame:
    return read_in_order(spark, *tick_feed(spark, sf))


def replayed_bars(spark, sf, delay: str) -> DataFrame:
    return replay(spark, *tick_feed(spark, sf), lambda ticks: sb.stream_bars(ticks, 15, delay))


_STREAM_BAR_SQL = f"SELECT exchange, symbol, open_time_ms, close_time_ms, open_time_h, interval, open, high, low, close, round(volume, {ROUND}) AS volume, trades_count FROM ({BAR_SQL15})"


@query("stream_bars", _STREAM_BAR_SQL)
def q_stream_bars(spark, sf):
    """X1 on a stream: event-time windows over ticks that come out of order."""
    return replayed_bars(spark, sf, DELAY).withColumn("volume", rnd("volume"))


@query("stream_bars_late", _STREAM_BAR_SQL)
def q_stream_bars_late(spark, sf):
    """The same feed under a watermark too short for it: bars that miss late ticks are built again."""
    got = replayed_bars(spark, sf, SHORT_DELAY)
    return sb.corrected_bars(events(spark, sf), got, 15).withColumn("volume", rnd("volume"))


@query("stream_collapse", REGISTRY["collapse_updates"].sql)
def q_stream_collapse(spark, sf):
    """F5 on a stream of decoded frames."""
    frames = materialize(good_frames(spark, sf))
    src = write_in_order(frames, ["recv_ms", "frame_no"])
    return replay(spark, src, frames.schema, stream_collapse, most=KEYED_FILES).select("recv_ms", "frame_no", "symbol", "interval", "start_ms", "closed")


@query("stream_signals", with_(oq.bandtastic_signal_ctes(BT_ACTIVE), SIG_SELECT))
def q_stream_signals(spark, sf):
    return run_stream(spark, bars(spark, sf, 15), Bandtastic(BT_ACTIVE), signals_of).select(*SIG_COLS)


@query("stream_macd_signals", with_(oq.macd_signal_ctes(MP), SIG_SELECT))
def q_stream_macd_signals(spark, sf):
    return run_stream(spark, bars(spark, sf, [60, 240]), MultiTimeFrameMacd(MP), signals_of).select(*SIG_COLS)


@query("stream_plugin_signals", with_(ema_cross_sql(EmaCrossParams(), BAR_SQL15), SIG_SELECT))
def q_stream_plugin_signals(spark, sf):
    return run_stream(spark, bars(spark, sf, 15), STRATEGIES["ema_cross"](), signals_of).select(*SIG_COLS)


@query("stream_trades", with_(oq.macd_signal_ctes(MP) + oq.ledger_select("sig"), TRADE_SELECT))
def q_stream_trades(spark, sf):
    return run_stream(spark, bars(spark, sf, [60, 240]), MultiTimeFrameMacd(MP), trades_of).withColumn("roi", rnd("roi"))


# ---- larger series: daily bars per supplier from lineitem -------------------------------------------

from ..sources.bars import lineitem_daily_bars, sql_lineitem_bars  # noqa: E402

BT_DAILY = BandtasticParams(**ACTIVE_BANDTASTIC, interval="1d", bar_minutes=1440)


def daily_bars(spark, sf) -> DataFrame:
    return lineitem_daily_bars(read_table(spark, sf, "lineitem"))


@query("daily_bars", f"SELECT * FROM ({sql_lineitem_bars()})")
def q_daily_bars(spark, sf):
    # Prices are one division per line item on both sides: compared unrounded.
    return daily_bars(spark, sf)


@query("daily_bandtastic_signals", with_(oq.bandtastic_signal_ctes(BT_DAILY, source=sql_lineitem_bars()), SIG_SELECT))
def q_daily_bandtastic(spark, sf):
    return Bandtastic(BT_DAILY).signals(daily_bars(spark, sf), CHUNK).select(*SIG_COLS)

"""DuckDB SQL for the correctness gate.

Each builder returns a complete ``SELECT`` over the driver's views that
computes, the plain sequential way (windows over whole series, recursive
CTEs for recurrences and state machines), what the matching Spark query
computes in chunks.  Constants are embedded with ``repr`` so both sides use
the same doubles.
"""

from __future__ import annotations

from ..functions.intervals import sql_canonical_interval
from ..operators.indicators import ema_alpha
from ..sources.bars import sql_event_bars
from ..strategies.bandtastic import BUY_TRIGGERS, SELL_TRIGGERS, BandtasticParams
from ..strategies.mtf_macd import MacdParams


def r(x: float) -> str:
    return repr(float(x))


# ---- Bollinger-band strategy ---------------------------------------------------------------

def bandtastic_feature_ctes(p: BandtasticParams, source: str | None = None) -> str:
    """CTEs ending in ``feat`` (one row per accepted bar with all features, buy, sell)."""
    src = source or sql_event_bars(p.bar_minutes)
    ks = {
        "bfe": ema_alpha(p.buy_fast_ema_period), "bse": ema_alpha(p.buy_slow_ema_period),
        "sfe": ema_alpha(p.sell_fast_ema_period), "sse": ema_alpha(p.sell_slow_ema_period),
    }
    ar = 1.0 / p.rsi_period if p.rsi_smoothing == "wilder" else ema_alpha(p.rsi_period)
    ema_steps = ", ".join(f"{r(1.0 - k)} * rec.{n} + {r(k)} * w.close" for n, k in ks.items())
    buy = []
    if p.buy_rsi_enabled:
        buy.append(f"rsi < {r(p.buy_rsi_threshold)}")
    if p.buy_mfi_enabled:
        buy.append(f"mfi < {r(p.buy_mfi_threshold)}")
    if p.buy_ema_enabled:
        buy.append("buy_fast_ema > buy_slow_ema")
    bk = BUY_TRIGGERS.get(p.buy_trigger)
    buy.append(f"close < bb_lower{bk}" if bk else "FALSE")
    buy.append("volume > 0.0")
    sell = []
    if p.sell_rsi_enabled:
        sell.append(f"rsi > {r(p.sell_rsi_threshold)}")
    if p.sell_mfi_enabled:
        sell.append(f"mfi > {r(p.sell_mfi_threshold)}")
    if p.sell_ema_enabled:
        sell.append("sell_fast_ema < sell_slow_ema")
    sk = SELL_TRIGGERS.get(p.sell_trigger)
    sell.append(f"close > bb_upper{sk}" if sk else "FALSE")
    sell.append("volume > 0.0")
    bands = ", ".join(f"bb_mid - {r(k)} * bb_sd AS bb_lower{k}, bb_mid + {r(k)} * bb_sd AS bb_upper{k}" for k in (1, 2, 3, 4))
    part = "PARTITION BY exchange, symbol ORDER BY seq"
    return f"""
bars AS ({src}),
b AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY close_time_ms, open_time_ms) AS seq,
             (high + low + close) / 3.0 AS tp
      FROM bars WHERE {sql_canonical_interval('interval')} = {sql_canonical_interval(repr(p.interval))}),
b2 AS (SELECT *, lag(close) OVER ({part}) AS prev_close, lag(tp) OVER ({part}) AS prev_tp FROM b),
b3 AS (SELECT *,
         CASE WHEN tp > prev_tp THEN tp * volume ELSE 0.0 END AS pos_flow,
         CASE WHEN tp < prev_tp THEN tp * volume ELSE 0.0 END AS neg_flow,
         CASE WHEN prev_close IS NULL THEN 0.0 ELSE greatest(close - prev_close, 0.0) END AS gain,
         CASE WHEN prev_close IS NULL THEN 0.0 ELSE greatest(-(close - prev_close), 0.0) END AS loss
       FROM b2),
w AS (SELECT *,
        avg(tp) OVER ({part} ROWS BETWEEN {p.bb_period - 1} PRECEDING AND CURRENT ROW) AS bb_mid,
        stddev_pop(tp) OVER ({part} ROWS BETWEEN {p.bb_period - 1} PRECEDING AND CURRENT ROW) AS bb_sd,
        max(close) OVER ({part} ROWS BETWEEN {p.high_period - 1} PRECEDING AND CURRENT ROW) AS high100,
        sum(pos_flow) OVER ({part} ROWS BETWEEN {p.mfi_period - 1} PRECEDING AND CURRENT ROW) AS sp,
        sum(neg_flow) OVER ({part} ROWS BETWEEN {p.mfi_period - 1} PRECEDING AND CURRENT ROW) AS sn
      FROM b3),
rec(exchange, symbol, seq, bfe, bse, sfe, sse, up, dn) AS (
  SELECT exchange, symbol, seq, close, close, close, close, gain, loss FROM w WHERE seq = 1
  UNION ALL
  SELECT w.exchange, w.symbol, w.seq, {ema_steps},
         {r(1.0 - ar)} * rec.up + {r(ar)} * w.gain, {r(1.0 - ar)} * rec.dn + {r(ar)} * w.loss
  FROM rec JOIN w ON w.exchange = rec.exchange AND w.symbol = rec.symbol AND w.seq = rec.seq + 1
),
f0 AS (SELECT w.*, rec.bfe AS buy_fast_ema, rec.bse AS buy_slow_ema, rec.sfe AS sell_fast_ema, rec.sse AS sell_slow_ema,
         CASE WHEN rec.up + rec.dn = 0 THEN 50.0 ELSE 100.0 * rec.up / (rec.up + rec.dn) END AS rsi,
         CASE WHEN sp + sn = 0 THEN 50.0 ELSE 100.0 * sp / (sp + sn) END AS mfi,
         {bands}
       FROM w JOIN rec USING (exchange, symbol, seq)),
feat AS (SELECT *, coalesce({' AND '.join(buy)}, FALSE) AS buy, coalesce({' AND '.join(sell)}, FALSE) AS sell FROM f0)"""


def bandtastic_signal_ctes(p: BandtasticParams, source: str | None = None) -> str:
    """``feat`` plus ``sig``: the state machine as a recursive CTE (last rule wins)."""
    rois = p.min_roi
    roi_when = []
    for i, (minutes, pct) in enumerate(rois):
        roi_when.append(
            f"WHEN r.pp IS NOT NULL AND f.seq - r.pi >= {int(minutes) // p.bar_minutes} AND f.close >= r.pp * {r(1.0 + pct)} THEN 'roi{i}'"
        )
    trail_gate = "TRUE" if not p.trailing_only_offset_is_reached else f"f.close > r.pp * {r(1.0 + p.trailing_stop_positive)}"
    trailing = (
        f"WHEN r.pp IS NOT NULL AND {trail_gate} AND f.close <= f.high100 - r.pp * {r(p.trailing_stop_positive_offset)} THEN 'TrailingStop'"
        if p.trailing_stop else ""
    )
    code = f"""CASE
        WHEN r.pp IS NOT NULL AND f.sell THEN 'StopProfit'
        WHEN r.pp IS NULL AND f.buy THEN 'Enter'
        {trailing}
        WHEN r.pp IS NOT NULL AND f.close <= r.pp * {r(1.0 + p.stoploss)} THEN 'StopLoss'
        {' '.join(roi_when)}
      END"""
    roi_min = " ".join(f"WHEN 'roi{i}' THEN {int(m)}" for i, (m, _) in enumerate(rois))
    roi_pct = " ".join(f"WHEN 'roi{i}' THEN {r(pc)}" for i, (_, pc) in enumerate(rois))
    return bandtastic_feature_ctes(p, source) + f""",
sm(exchange, symbol, seq, pp, pi, code, price) AS (
  SELECT DISTINCT exchange, symbol, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM feat
  UNION ALL
  SELECT x.exchange, x.symbol, x.seq,
         CASE WHEN x.code = 'Enter' THEN x.close WHEN x.code IS NOT NULL THEN NULL ELSE x.pp END,
         CASE WHEN x.code = 'Enter' THEN x.seq WHEN x.code IS NOT NULL THEN NULL ELSE x.pi END,
         x.code, x.close
  FROM (SELECT f.exchange, f.symbol, f.seq, f.close, r.pp, r.pi, {code} AS code
        FROM sm r JOIN feat f ON f.exchange = r.exchange AND f.symbol = r.symbol AND f.seq = r.seq + 1) x
),
sig AS (
  SELECT sm.exchange, sm.symbol, sm.seq, feat.close_time_ms AS ts_ms,
         CASE WHEN code = 'Enter' THEN 'Enter' ELSE 'Exit' END AS kind,
         CASE WHEN code = 'Enter' THEN 'Long' END AS direction,
         CASE WHEN code = 'Enter' THEN NULL WHEN code LIKE 'roi%' THEN 'Roi' ELSE code END AS reason,
         CASE code {roi_min} END AS roi_minutes,
         CASE code {roi_pct} END AS roi_pct,
         sm.price
  FROM sm JOIN feat USING (exchange, symbol, seq) WHERE code IS NOT NULL
)"""


# ---- multi-timeframe MACD -------------------------------------------------------------

def macd_feature_ctes(p: MacdParams, source: str | None = None) -> str:
    """CTEs ending in ``mf``: merged 60m/240m rows with aligned MACD values and F8-F10."""
    src = source or f"{sql_event_bars(60)} UNION ALL {sql_event_bars(240)}"
    kf, ks, kg = ema_alpha(p.fast_length), ema_alpha(p.slow_length), ema_alpha(p.signal_length)
    ci = sql_canonical_interval("interval")
    long_c = sql_canonical_interval(repr(p.long_trend_time))
    if p.carry_forward:
        four = {
            n: f"last_value(CASE WHEN NOT is_short THEN {n} END IGNORE NULLS) OVER (PARTITION BY exchange, symbol ORDER BY close_time_ms, interval_rank, open_time_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            for n in ("macd", "signal", "hist")
        }
    else:
        four = {n: f"CASE WHEN NOT is_short THEN {n} END" for n in ("macd", "signal", "hist")}
    return f"""
bars AS ({src}),
tb AS (SELECT *, {ci} AS interval_c,
              row_number() OVER (PARTITION BY exchange, symbol, {ci} ORDER BY close_time_ms, open_time_ms) AS tf_seq
       FROM bars WHERE {ci} = '60m' OR {ci} = {long_c}),
mrec(exchange, symbol, interval_c, tf_seq, ef, es, m, s) AS (
  SELECT exchange, symbol, interval_c, tf_seq, close, close, close - close, close - close FROM tb WHERE tf_seq = 1
  UNION ALL
  SELECT t.exchange, t.symbol, t.interval_c, t.tf_seq,
         {r(1 - kf)} * q.ef + {r(kf)} * t.close,
         {r(1 - ks)} * q.es + {r(ks)} * t.close,
         ({r(1 - kf)} * q.ef + {r(kf)} * t.close) - ({r(1 - ks)} * q.es + {r(ks)} * t.close),
         {r(1 - kg)} * q.s + {r(kg)} * (({r(1 - kf)} * q.ef + {r(kf)} * t.close) - ({r(1 - ks)} * q.es + {r(ks)} * t.close))
  FROM mrec q JOIN tb t ON t.exchange = q.exchange AND t.symbol = q.symbol AND t.interval_c = q.interval_c AND t.tf_seq = q.tf_seq + 1
),
mt AS (SELECT tb.*, mrec.m AS macd, mrec.s AS signal, mrec.m - mrec.s AS hist,
              interval_c = '60m' AS is_short, CASE WHEN interval_c = '60m' THEN 1 ELSE 0 END AS interval_rank
       FROM tb JOIN mrec USING (exchange, symbol, interval_c, tf_seq)),
mu AS (SELECT *,
         row_number() OVER (PARTITION BY exchange, symbol ORDER BY close_time_ms, interval_rank, open_time_ms) AS seq,
         sum(CASE WHEN is_short THEN 1 ELSE 0 END) OVER (PARTITION BY exchange, symbol ORDER BY close_time_ms, interval_rank, open_time_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bar_index,
         {four['macd']} AS macd_4h, {four['signal']} AS signal_4h, {four['hist']} AS hist_4h,
         CASE WHEN is_short THEN macd END AS macd_1h, CASE WHEN is_short THEN signal END AS signal_1h,
         CASE WHEN is_short THEN hist END AS hist_1h
       FROM mt),
mf AS (SELECT *,
         coalesce(hist_4h IS NOT NULL AND (macd_4h > signal_4h OR hist_4h > 0), FALSE) AS long_trend,
         coalesce(hist_4h IS NOT NULL AND (macd_4h < signal_4h OR hist_4h < 0), FALSE) AS short_trend,
         coalesce(hist_4h IS NOT NULL AND macd_4h < signal_4h, FALSE) AS long_exit,
         coalesce(hist_4h IS NOT NULL AND macd_4h > signal_4h, FALSE) AS short_exit
       FROM mu),
feat AS (SELECT *,
         long_trend AND coalesce(macd_1h > signal_1h AND hist_1h > 0, FALSE) AS long_entry,
         short_trend AND coalesce(macd_1h < signal_1h AND hist_1h < 0, FALSE) AS short_entry
       FROM mf)"""


def macd_signal_ctes(p: MacdParams, source: str | None = None) -> str:
    up = r(1.0 + p.breakeven_threshold / 100.0)
    dn = r(1.0 - p.breakeven_threshold / 100.0)
    trail = r(1.0 + p.trail_offset / 100.0)
    # x: state before the bar (sz, pp, ep, armed) and the bar; y adds the armed flag after arming.
    return macd_feature_ctes(p, source) + f""",
sm(exchange, symbol, seq, sz, pp, ep, armed, code, price) AS (
  SELECT DISTINCT exchange, symbol, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), FALSE,
         CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM feat
  UNION ALL
  SELECT z.exchange, z.symbol, z.seq,
         CASE WHEN z.code IN ('EnterLong', 'EnterShort') THEN (CASE WHEN z.code = 'EnterLong' THEN 1.0 ELSE -1.0 END)
              WHEN z.code IS NOT NULL THEN NULL ELSE z.sz END,
         CASE WHEN z.code IN ('EnterLong', 'EnterShort') THEN z.close WHEN z.code IS NOT NULL THEN NULL ELSE z.pp END,
         CASE WHEN z.code IN ('EnterLong', 'EnterShort') THEN z.close ELSE z.ep2 END,
         CASE WHEN z.code IN ('EnterLong', 'EnterShort') THEN FALSE ELSE z.armed2 END,
         z.code, z.close
  FROM (
    SELECT y.*,
      CASE
        WHEN y.sz IS NULL AND y.long_entry THEN 'EnterLong'
        WHEN y.sz IS NULL AND y.short_entry THEN 'EnterShort'
        WHEN y.sz > 0 AND y.long_exit THEN 'StopProfit'
        WHEN y.sz < 0 AND y.short_exit THEN 'StopProfit'
        WHEN y.armed2 AND y.sz IS NOT NULL AND y.ep2 IS NOT NULL AND y.sz > 0
             AND y.close <= (CASE WHEN y.ep2 > 0 THEN y.ep2 * {trail} ELSE 0.0 END) THEN 'TrailingStop'
        WHEN y.armed2 AND y.sz IS NOT NULL AND y.ep2 IS NOT NULL AND y.sz < 0
             AND y.close >= (CASE WHEN y.ep2 > 0 THEN y.ep2 * {trail} ELSE 0.0 END) THEN 'TrailingStop'
      END AS code
    FROM (
      SELECT x.*,
        CASE WHEN x.sz IS NOT NULL AND NOT x.armed AND coalesce(x.ep, x.pp) IS NOT NULL THEN
               (CASE WHEN x.sz > 0 THEN x.close >= coalesce(x.ep, x.pp) * {up} ELSE x.close <= coalesce(x.ep, x.pp) * {dn} END)
             ELSE x.armed END AS armed2,
        CASE WHEN x.sz IS NOT NULL THEN coalesce(x.ep, x.pp) ELSE x.ep END AS ep2
      FROM (SELECT f.exchange, f.symbol, f.seq, f.close, f.long_entry, f.short_entry, f.long_exit, f.short_exit,
                   r.sz, r.pp, r.ep, r.armed
            FROM sm r JOIN feat f ON f.exchange = r.exchange AND f.symbol = r.symbol AND f.seq = r.seq + 1) x
    ) y
  ) z
),
sig AS (
  SELECT sm.exchange, sm.symbol, sm.seq, feat.close_time_ms AS ts_ms,
         CASE WHEN code LIKE 'Enter%' THEN 'Enter' ELSE 'Exit' END AS kind,
         CASE code WHEN 'EnterLong' THEN 'Long' WHEN 'EnterShort' THEN 'Short' END AS direction,
         CASE WHEN code LIKE 'Enter%' THEN NULL ELSE code END AS reason,
         CAST(NULL AS BIGINT) AS roi_minutes, CAST(NULL AS DOUBLE) AS roi_pct, sm.price
  FROM sm JOIN feat USING (exchange, symbol, seq) WHERE code IS NOT NULL
)"""


# ---- ledger -----------------------------------------------------------------------------

def ledger_select(signals_cte: str, fee: float = 0.06, literal_roi: bool = False) -> str:
    """Trade events from a CTE named ``signals_cte`` (exchange, symbol, seq, ts_ms, kind, direction, reason, roi_minutes, roi_pct, price)."""
    roi = "CAST(NULL AS DOUBLE)" if literal_roi else (
        f"CASE WHEN o.open_direction = 'Long' THEN (c.exit_price - o.enter_price) / NULLIF(o.enter_price, 0.0) * 100.0 - {r(fee)} * 100.0 "
        f"WHEN o.open_direction = 'Short' THEN (o.enter_price - c.exit_price) / NULLIF(o.enter_price, 0.0) * 100.0 - {r(fee)} * 100.0 END"
    )
    return f""",
acc0 AS (SELECT *, lag(kind) OVER (PARTITION BY exchange, symbol ORDER BY ts_ms, seq) AS prev_kind FROM {signals_cte}),
acc AS (SELECT *,
          sum(CASE WHEN kind = 'Enter' THEN 1 ELSE 0 END) OVER (PARTITION BY exchange, symbol ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_enter,
          sum(CASE WHEN kind = 'Exit' THEN 1 ELSE 0 END) OVER (PARTITION BY exchange, symbol ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_exit
        FROM acc0 WHERE kind <> coalesce(prev_kind, 'Exit')),
o AS (SELECT exchange, symbol, n_enter AS trade_no, direction AS open_direction, price AS enter_price, ts_ms AS enter_time FROM acc WHERE kind = 'Enter'),
c AS (SELECT exchange, symbol, n_exit AS trade_no, price AS exit_price, ts_ms AS exit_time, reason AS exit_reason, roi_minutes, roi_pct FROM acc WHERE kind = 'Exit'),
trades AS (
  SELECT exchange, symbol, 'open' AS event, open_direction AS direction, enter_price, CAST(NULL AS DOUBLE) AS exit_price,
         enter_time, CAST(0 AS BIGINT) AS exit_time, 'None' AS exit_reason, CAST(NULL AS BIGINT) AS roi_minutes,
         CAST(NULL AS DOUBLE) AS roi_pct, CAST(NULL AS DOUBLE) AS roi, {r(fee)} AS fee
  FROM o
  UNION ALL
  SELECT c.exchange, c.symbol, 'close', CASE o.open_direction WHEN 'Long' THEN 'LongClose' WHEN 'Short' THEN 'ShortClose' ELSE o.open_direction END,
         o.enter_price, c.exit_price, o.enter_time, c.exit_time, c.exit_reason, c.roi_minutes, c.roi_pct, {roi}, {r(fee)}
  FROM c JOIN o ON o.exchange = c.exchange AND o.symbol = c.symbol AND o.trade_no = c.trade_no
)"""

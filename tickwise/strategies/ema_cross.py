"""U1 example: a strategy added through the plugin interface.

Long when the fast EMA of close is above the slow one, flat when below.
Features are two recurrences in one scan pass; the position is its entry price.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.intervals import canonical_interval
from ..operators.fold import Exit
from ..operators.indicators import ema_alpha, ema_spec
from ..operators import snapshot as snap
from ..operators.scan import affine_scan
from ..operators.series import DEFAULT_CHUNK_ROWS, sequence
from ..streaming.online import TypedState
from .base import KEYS, LONG, STOP_PROFIT, Params, Strategy, register


@dataclass(frozen=True)
class EmaCrossParams(Params):
    fast: int = 9
    slow: int = 21
    interval: str = "15m"
    bar_minutes: int = 15


@register
class EmaCross(Strategy):
    name = "ema_cross"
    params_type = EmaCrossParams
    state_fields = [("pos_price", T.DoubleType())]
    row_columns = ["close", "fast_ema", "slow_ema"]

    def accepted(self, bars: DataFrame) -> DataFrame:
        b = bars.withColumn("interval_c", canonical_interval("interval")).withColumn("interval_rank", F.lit(0))
        return b.filter(F.col("interval_c") == canonical_interval(F.lit(self.params.interval)))

    def online(self):
        return OnlineEmaCross(self.params)

    def features(self, bars: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS, snapshot: DataFrame | None = None) -> DataFrame:
        p = self.params
        own = snap.series_of(snapshot, self.main_series)
        slot = F.floor(F.col("close_time_ms") / F.lit(p.bar_minutes * 60000 * chunk_rows))
        b = sequence(self.accepted(bars), KEYS, ["close_time_ms", "open_time_ms"], slot, start=own, base_col="_base")
        specs = [ema_spec("fast_ema", F.col("close"), ema_alpha(p.fast)), ema_spec("slow_ema", F.col("close"), ema_alpha(p.slow))]
        ends = snap.values_of(own, KEYS, {"fast_ema": "double", "slow_ema": "double"})
        b = affine_scan(b, KEYS, specs, chunk_rows=chunk_rows, base_col="_base", initial=ends)
        return b.withColumn("ts_ms", F.col("close_time_ms"))

    def series_ends(self, features: DataFrame, chunk_rows: int) -> DataFrame:
        return snap.taken(features, F.lit(self.main_series), {n: F.col(n) for n in ("fast_ema", "slow_ema")})

    def entries(self, bars):
        return [(LONG, bars["fast_ema"] > bars["slow_ema"])]

    def opened(self, bars, at, direction):
        return (float(bars["close"][at]),)

    def exits(self, state, bars):
        return [Exit(STOP_PROFIT, bars["fast_ema"] < bars["slow_ema"])]

    bound_names = ["crossed"]

    def bounds(self, bars):
        return [(bars["fast_ema"] < bars["slow_ema"]).any()]

    def passes(self, state, bounds):
        return None if bounds["crossed"] else state


class OnlineEmaCross(TypedState):
    """Both averages, one bar at a time."""

    schema = "ema array<double>"

    def __init__(self, params: EmaCrossParams):
        self.rates = (ema_alpha(params.fast), ema_alpha(params.slow))

    def new(self) -> dict:
        return {"ema": None}

    def row(self, st: dict, bar) -> tuple:
        before = st["ema"] or [bar.close, bar.close]
        st["ema"] = [(1.0 - a) * e + a * bar.close if st["ema"] else bar.close for a, e in zip(self.rates, before)]
        return (bar.close, *st["ema"])


def ema_cross_sql(p: EmaCrossParams, bars_sql: str) -> str:
    kf, ks = ema_alpha(p.fast), ema_alpha(p.slow)
    r = repr
    return f"""
b AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY close_time_ms, open_time_ms) AS seq FROM ({bars_sql}) x WHERE interval = '{p.interval}'),
e(exchange, symbol, seq, f, s) AS (
  SELECT exchange, symbol, seq, close, close FROM b WHERE seq = 1
  UNION ALL
  SELECT b.exchange, b.symbol, b.seq, {r(1 - kf)} * e.f + {r(kf)} * b.close, {r(1 - ks)} * e.s + {r(ks)} * b.close
  FROM e JOIN b ON b.exchange = e.exchange AND b.symbol = e.symbol AND b.seq = e.seq + 1),
feat AS (SELECT b.*, e.f AS fast_ema, e.s AS slow_ema FROM b JOIN e USING (exchange, symbol, seq)),
sm(exchange, symbol, seq, pp, code, price) AS (
  SELECT DISTINCT exchange, symbol, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM feat
  UNION ALL
  SELECT x.exchange, x.symbol, x.seq,
         CASE WHEN x.code = 'Enter' THEN x.close WHEN x.code = 'Exit' THEN NULL ELSE x.pp END, x.code, x.close
  FROM (SELECT f.exchange, f.symbol, f.seq, f.close, r.pp,
               CASE WHEN r.pp IS NULL AND f.fast_ema > f.slow_ema THEN 'Enter'
                    WHEN r.pp IS NOT NULL AND f.fast_ema < f.slow_ema THEN 'Exit' END AS code
        FROM sm r JOIN feat f ON f.exchange = r.exchange AND f.symbol = r.symbol AND f.seq = r.seq + 1) x),
sig AS (SELECT sm.exchange, sm.symbol, sm.seq, feat.close_time_ms AS ts_ms, code AS kind,
               CASE WHEN code = 'Enter' THEN 'Long' END AS direction, CASE WHEN code = 'Exit' THEN 'StopProfit' END AS reason,
               CAST(NULL AS BIGINT) AS roi_minutes, CAST(NULL AS DOUBLE) AS roi_pct, sm.price
        FROM sm JOIN feat USING (exchange, symbol, seq) WHERE code IS NOT NULL)"""

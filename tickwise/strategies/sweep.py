"""Many settings of a strategy in one job.

A table of settings (a name and a JSON document each) is evaluated over the
same bars.  Settings differ in periods, thresholds and rules; what they share
is computed once: one numbering of the series, one window pass with every
distinct window period, one scan with every distinct recurrence.  The rules
are then evaluated for each (key, setting) on the arrays of each chunk, which
is read once for all settings.

The settings are configuration: they are collected to the driver and travel
with the tasks.  The bars' columns grow with the distinct periods, not with
the settings, and no row is repeated per setting.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.fold import fold_series
from ..operators.indicators import BB_MULTIPLIERS, bar_windows_of, ema_alpha, ema_spec, rsi_specs, rsi_value
from ..operators.scan import affine_scan
from ..operators.series import DEFAULT_CHUNK_ROWS, sequence
from .bandtastic import Bandtastic, BandtasticParams, buy_rule, sell_rule
from .base import KEYS

_EMAS = ("buy_fast_ema", "buy_slow_ema", "sell_fast_ema", "sell_slow_ema")


class SweptBandtastic(Bandtastic):
    """One setting, whose rules read the shared columns named by their periods."""

    def __init__(self, params: BandtasticParams):
        super().__init__(params)
        p = self.params
        self.ema = {name: f"ema_{getattr(p, f'{name}_period')}" for name in _EMAS}
        self.rsi, self.mfi = f"rsi_{p.rsi_smoothing}_{p.rsi_period}", f"mfi_{p.mfi_period}"
        self.bands, self.high = f"bb_{p.bb_period}", f"high_{p.high_period}"
        shared = [*self.ema.values(), self.rsi, self.mfi, f"{self.bands}_mid", f"{self.bands}_sd", self.high]
        self.row_columns = ["seq", "close", "volume", *dict.fromkeys(shared)]

    def bars_of(self, rows):
        mid, sd = rows[f"{self.bands}_mid"], rows[f"{self.bands}_sd"]
        v = {"close": rows["close"], "volume": rows["volume"], "rsi": rows[self.rsi], "mfi": rows[self.mfi]}
        v |= {name: rows[c] for name, c in self.ema.items()}
        v |= {f"bb_lower{k}": mid - float(k) * sd for k in BB_MULTIPLIERS} | {f"bb_upper{k}": mid + float(k) * sd for k in BB_MULTIPLIERS}
        with np.errstate(invalid="ignore"):
            return {"seq": rows["seq"], "close": rows["close"], "high100": rows[self.high], "buy": buy_rule(self.params, v), "sell": sell_rule(self.params, v)}


def swept_features(bars: DataFrame, settings: list[SweptBandtastic], chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The shared columns of all settings: every distinct period once."""
    params = [s.params for s in settings]
    if len({(p.interval, p.bar_minutes) for p in params}) != 1:
        raise ValueError("the settings of a sweep read bars of one interval")
    slot = F.floor(F.col("close_time_ms") / F.lit(params[0].bar_minutes * 60000 * chunk_rows))
    b = sequence(settings[0].accepted(bars).select(*KEYS, "close_time_ms", "open_time_ms", "high", "low", "close", "volume"),
                 KEYS, ["close_time_ms", "open_time_ms"], slot)
    b = bar_windows_of(
        b, KEYS, {s.bands: s.params.bb_period for s in settings}, {s.mfi: s.params.mfi_period for s in settings},
        {s.high: s.params.high_period for s in settings}, chunk_rows=chunk_rows,
    ).drop("high", "low")
    emas = {s.ema[name]: getattr(s.params, f"{name}_period") for s in settings for name in _EMAS}
    rsis = {s.rsi: (s.params.rsi_period, s.params.rsi_smoothing) for s in settings}
    specs = [ema_spec(name, F.col("close"), ema_alpha(n)) for name, n in emas.items()]
    specs += [x for name, (n, smoothing) in rsis.items() for x in rsi_specs(n, smoothing, name=f"_{name}")]
    b = affine_scan(b, KEYS, specs, chunk_rows=chunk_rows)
    b = b.withColumns({name: rsi_value(f"_{name}_up", f"_{name}_down") for name in rsis})
    return b.withColumn("ts_ms", F.col("close_time_ms"))


def sweep(bars: DataFrame, settings: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The signals of every setting, with its name.

    ``settings``: (setting, params), a table of names and JSON documents;
    absent parameters keep their defaults.  Equal to one run per setting."""
    rows = settings.select("setting", "params").collect()  # configuration
    names = [r["setting"] for r in rows]
    if len(set(names)) != len(names):
        raise ValueError("a setting's name occurs twice")
    specs = [SweptBandtastic(BandtasticParams.from_json(r["params"] or "{}")) for r in rows]
    if not specs:
        raise ValueError("no settings")
    signals, _ = fold_series(swept_features(bars, specs, chunk_rows), KEYS, specs, chunk_rows=chunk_rows, setting_col="_number")
    table = settings.sparkSession.createDataFrame(list(enumerate(names)), f"_number int, setting {settings.schema['setting'].dataType.simpleString()}")
    return signals.join(F.broadcast(table), "_number").drop("_number")

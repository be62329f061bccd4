"""Features one bar at a time, for the streaming evaluation (T5).

Each class keeps a small state -- running averages and the last few values of
the windowed indicators -- and returns, per bar, the values that the strategy's
rules read.  ``schema`` is the state's type in the state store.
"""

from __future__ import annotations

import math

from ..operators.indicators import BB_MULTIPLIERS, ema_alpha
from ..strategies.bandtastic import buy_rule, sell_rule
from ..strategies.mtf_macd import ALIGNED, SHORT_INTERVAL, conditions


def _ema(prev, x, alpha, first):
    return x if first else (1.0 - alpha) * prev + alpha * x


class TypedState:
    """A dict of state fields as a row of ``schema``, and back."""

    schema = ""

    def new(self) -> dict:
        raise NotImplementedError

    def pack(self, st: dict) -> tuple:
        return tuple(st.values())

    def unpack(self, row: tuple) -> dict:
        return dict(zip(self.new(), row))


class OnlineBandtastic(TypedState):
    """Online features of the Bollinger-band strategy."""

    schema = (
        "n bigint, prev_close double, ema array<double>, up double, dn double, tp array<double>, "
        "last_tp double, pos array<double>, neg array<double>, closes array<double>"
    )

    def __init__(self, params):
        self.p = params

    def new(self) -> dict:
        return {"n": 0, "prev_close": None, "ema": [0.0, 0.0, 0.0, 0.0], "up": 0.0, "dn": 0.0,
                "tp": [], "last_tp": None, "pos": [], "neg": [], "closes": []}

    def row(self, st: dict, bar) -> tuple:
        p = self.p
        st["n"] += 1
        first = st["n"] == 1
        close, high, low, volume = bar.close, bar.high, bar.low, bar.volume
        tp = (high + low + close) / 3.0
        # Bollinger over the last bb_period typical prices (population deviation).
        st["tp"] = [*st["tp"], tp][-p.bb_period:]
        mean = sum(st["tp"]) / len(st["tp"])
        sd = math.sqrt(max(sum((x - mean) ** 2 for x in st["tp"]) / len(st["tp"]), 0.0))
        # Money flow over the last mfi_period flows.
        before = st["last_tp"]
        st["pos"] = [*st["pos"], tp * volume if before is not None and tp > before else 0.0][-p.mfi_period:]
        st["neg"] = [*st["neg"], tp * volume if before is not None and tp < before else 0.0][-p.mfi_period:]
        st["last_tp"] = tp
        sp, sn = sum(st["pos"]), sum(st["neg"])
        mfi = 50.0 if sp + sn == 0 else 100.0 * sp / (sp + sn)
        # EMAs and RSI.
        periods = [p.buy_fast_ema_period, p.buy_slow_ema_period, p.sell_fast_ema_period, p.sell_slow_ema_period]
        st["ema"] = [_ema(e, close, ema_alpha(n), first) for e, n in zip(st["ema"], periods)]
        prev = st["prev_close"]
        gain = 0.0 if prev is None else max(close - prev, 0.0)
        loss = 0.0 if prev is None else max(-(close - prev), 0.0)
        a = 1.0 / p.rsi_period if p.rsi_smoothing == "wilder" else ema_alpha(p.rsi_period)
        st["up"] = _ema(st["up"], gain, a, first)
        st["dn"] = _ema(st["dn"], loss, a, first)
        rsi = 50.0 if st["up"] + st["dn"] == 0 else 100.0 * st["up"] / (st["up"] + st["dn"])
        st["prev_close"] = close
        st["closes"] = [*st["closes"], close][-p.high_period:]
        high100 = max(st["closes"])
        names = ("buy_fast_ema", "buy_slow_ema", "sell_fast_ema", "sell_slow_ema")
        values = {"close": close, "volume": volume, "rsi": rsi, "mfi": mfi, **dict(zip(names, st["ema"]))}
        values |= {f"bb_lower{k}": mean - float(k) * sd for k in BB_MULTIPLIERS} | {f"bb_upper{k}": mean + float(k) * sd for k in BB_MULTIPLIERS}
        return (st["n"], close, high100, buy_rule(p, values), sell_rule(p, values))


class OnlineMacd(TypedState):
    """Online features of the multi-timeframe MACD strategy.  Per interval: bars, both averages, signal line."""

    schema = "tf map<string, array<double>>, bar_index bigint, four array<double>"

    def __init__(self, params):
        self.p = params

    def new(self) -> dict:
        return {"tf": {}, "bar_index": 0, "four": None}

    def row(self, st: dict, bar) -> tuple:
        p = self.p
        n, fast, slow, line = st["tf"].get(bar.interval_c, (0.0, 0.0, 0.0, 0.0))
        first = n == 0
        fast = _ema(fast, bar.close, ema_alpha(p.fast_length), first)
        slow = _ema(slow, bar.close, ema_alpha(p.slow_length), first)
        m = fast - slow
        line = _ema(line, m, ema_alpha(p.signal_length), first)
        st["tf"] = {**st["tf"], bar.interval_c: [n + 1.0, fast, slow, line]}
        vals = (m, line, m - line)
        if bar.interval_c == SHORT_INTERVAL:
            st["bar_index"] += 1
            one = vals
            four = st["four"] if p.carry_forward else None
        else:
            one = None
            four = vals
            st["four"] = list(vals)
        absent = (math.nan,) * 3
        found = conditions(dict(zip(ALIGNED, (*(one or absent), *(four or absent)))))
        return (st["bar_index"], bar.close, *[found[c] for c in ("long_entry", "short_entry", "long_exit", "short_exit")])

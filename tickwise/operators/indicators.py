"""Indicators: bounded windows (W1-W4) and recurrences.

Windows use ``halo_window`` (bounded groups); recurrences use the affine
scan.  Every indicator is defined from the first bar on (partial windows),
from the published formulas:

* Bollinger: mean and population deviation of hlc3 over ``n`` bars.
* MFI: money flow = typical price * volume, positive when the typical price
  rose against the previous bar, negative when it fell; 50 when no flow.
* EMA: ``k = 2/(n+1)``, seeded with the first value.
* RSI: smoothed gains and losses (Wilder ``1/n`` or EMA ``2/(n+1)``), seeded
  with the first value; 50 when both are 0.
* MACD: EMA(fast) - EMA(slow), signal = EMA(signal) of it, histogram = diff.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.numbers import hlc3
from .scan import Affine, affine_scan
from .series import DEFAULT_CHUNK_ROWS, halo_window

BB_MULTIPLIERS = (1, 2, 3, 4)


def ema_alpha(n: int) -> float:
    return 2.0 / (n + 1)


def ema_spec(name: str, x: Column, alpha: float, seq_col: str = "seq") -> Affine:
    first = F.col(seq_col) == 1
    return Affine(name, F.when(first, F.lit(0.0)).otherwise(F.lit(1.0 - alpha)), F.when(first, x).otherwise(F.lit(alpha) * x))


# ---- bounded windows -------------------------------------------------------------------

def frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def bollinger_bands(df: DataFrame, ks: Sequence[int] = BB_MULTIPLIERS, prefix: str = "bb") -> DataFrame:
    """Lower/upper bands from the mid and deviation columns."""
    for k in ks:
        df = df.withColumn(f"{prefix}_lower{k}", F.col(f"{prefix}_mid") - F.lit(float(k)) * F.col(f"{prefix}_sd"))
        df = df.withColumn(f"{prefix}_upper{k}", F.col(f"{prefix}_mid") + F.lit(float(k)) * F.col(f"{prefix}_sd"))
    return df


def _block(n: int) -> int:
    """Largest divisor of ``n`` not above its square root."""
    return max(d for d in range(1, int(n ** 0.5) + 1) if n % d == 0)


def bar_windows(
    bars: DataFrame,
    keys: Sequence[str],
    bb_n: int = 20,
    mfi_n: int = 14,
    high_n: int = 100,
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    tp: Column | None = None,
    chunk_col: str | None = None,
) -> DataFrame:
    """W1, W2, W3 and the previous close, in one window pass over (key, chunk)."""
    out = bar_windows_of(bars, keys, {"bb": bb_n}, {"mfi": mfi_n}, {"high100": high_n}, seq_col, chunk_rows, tp, chunk_col)
    return bollinger_bands(out)


def bar_windows_of(
    bars: DataFrame,
    keys: Sequence[str],
    bb: dict[str, int],
    mfi: dict[str, int],
    high: dict[str, int],
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    tp: Column | None = None,
    chunk_col: str | None = None,
) -> DataFrame:
    """Windows of any number of periods in one pass: ``<name>_mid`` and
    ``<name>_sd`` for each (name, period) in ``bb``, a column for each in
    ``mfi`` and ``high``, and ``prev_close``.  ``tp`` is the typical price of bars
    that come without high and low; ``chunk_col`` as in ``halo_window``.

    Stage 1: previous close and typical price, and the maximum over blocks of
    ``b`` rows; stage 2: band mean/deviation, money-flow sums, and the rolling
    high as the maximum of ``n / b`` lagged block maxima (about 2*sqrt(n) work
    per row instead of n)."""
    blocks = {name: _block(n) for name, n in high.items()}
    tp = hlc3() if tp is None else tp

    def build(w: WindowSpec) -> list[dict[str, Column]]:
        first = {
            "_tp": tp,
            "prev_close": F.lag("close", 1).over(w),
            "_prev_tp": F.lag(tp, 1).over(w),
            **{f"_max{b}": F.max("close").over(frame(w, b)) for b in set(blocks.values())},
        }
        pos = F.when(F.col("_tp") > F.col("_prev_tp"), F.col("_tp") * F.col("volume")).otherwise(F.lit(0.0))
        neg = F.when(F.col("_tp") < F.col("_prev_tp"), F.col("_tp") * F.col("volume")).otherwise(F.lit(0.0))
        second: dict[str, Column] = {}
        for name, n in bb.items():
            second |= {f"{name}_mid": F.avg("_tp").over(frame(w, n)), f"{name}_sd": F.stddev_pop("_tp").over(frame(w, n))}
        for name, n in mfi.items():
            sp, sn = F.sum(pos).over(frame(w, n)), F.sum(neg).over(frame(w, n))
            second[name] = F.when(sp + sn == 0, F.lit(50.0)).otherwise(F.lit(100.0) * sp / (sp + sn))
        for name, n in high.items():
            b = blocks[name]
            lags = [F.col(f"_max{b}")] + [F.lag(f"_max{b}", k * b).over(w) for k in range(1, n // b)]
            second[name] = F.greatest(*lags) if len(lags) > 1 else lags[0]
        return [first, second]

    halo = max([1, *[n - 1 for n in bb.values()], *mfi.values(), *[n - 1 for n in high.values()]])
    return halo_window(bars, keys, build, halo, seq_col, chunk_rows, chunk_col=chunk_col).drop("_tp", "_prev_tp", *{f"_max{b}" for b in blocks.values()})


# ---- recurrences -----------------------------------------------------------------------

def rsi_specs(n: int, smoothing: str = "wilder", close: str = "close", prev: str = "prev_close",
              seq_col: str = "seq", name: str = "_rsi") -> list[Affine]:
    alpha = 1.0 / n if smoothing == "wilder" else ema_alpha(n)
    diff = F.col(close) - F.col(prev)
    gain = F.when(F.col(prev).isNull(), F.lit(0.0)).otherwise(F.greatest(diff, F.lit(0.0)))
    loss = F.when(F.col(prev).isNull(), F.lit(0.0)).otherwise(F.greatest(-diff, F.lit(0.0)))
    return [ema_spec(f"{name}_up", gain, alpha, seq_col), ema_spec(f"{name}_down", loss, alpha, seq_col)]


def rsi_value(up: str = "_rsi_up", down: str = "_rsi_down") -> Column:
    total = F.col(up) + F.col(down)
    return F.when(total == 0, F.lit(50.0)).otherwise(F.lit(100.0) * F.col(up) / total)


def macd(df: DataFrame, keys: Sequence[str], fast: int = 12, slow: int = 26, signal: int = 9, x: str = "close",
         seq_col: str = "seq", chunk_rows: int = DEFAULT_CHUNK_ROWS, prefix: str = "", base_col: str | None = None,
         initial: DataFrame | None = None) -> DataFrame:
    """Macd, signal and histogram columns, all in one scan; ``_ema_fast``
    and ``_ema_slow`` are the averages (with the signal line, the ends that
    ``initial`` goes on from).

    The signal line averages the difference of the averages; written with
    their previous values, signal_t = a * signal_{t-1} + k * (b_fast - b_slow)
    + k * a_fast * fast_{t-1} - k * a_slow * slow_{t-1}."""
    p = prefix
    f, s = (ema_spec(name, F.col(x), ema_alpha(n), seq_col) for name, n in (("_ema_fast", fast), ("_ema_slow", slow)))
    line = ema_spec(f"{p}signal", f.b - s.b, ema_alpha(signal), seq_col)
    k = F.when(F.col(seq_col) == 1, F.lit(1.0)).otherwise(F.lit(ema_alpha(signal)))
    line.feeds = {f.name: k * f.a, s.name: -k * s.a}
    out = affine_scan(df, keys, [f, s, line], seq_col, chunk_rows, base_col, initial).withColumn(f"{p}macd", F.col("_ema_fast") - F.col("_ema_slow"))
    return out.withColumn(f"{p}hist", F.col(f"{p}macd") - F.col(f"{p}signal"))

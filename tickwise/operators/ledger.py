"""Signals -> trade events, and C4 (return of a closed trade).

The ledger is a two-state machine whose state after any signal is that
signal's kind (an Enter opens or keeps open, an Exit closes or keeps
closed), so it needs no fold:

* a signal is accepted iff its kind differs from the previous signal's kind
  (the state starts closed) -- a one-row look-back;
* accepted signals alternate Enter, Exit, Enter, ..., so an accepted Exit closes
  the latest accepted Enter before it -- an as-of carry along the same series.

Both steps run on bounded chunks of one numbered series (``halo_window``,
``forward_fill``): no self-join.  Event times are the bar close times of the
signals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..strategies.base import ENTER, EXIT, KEYS, LONG, LONG_CLOSE, NO_REASON, SHORT, SHORT_CLOSE
from .series import DEFAULT_CHUNK_ROWS, forward_fill, halo_window, sequence_rows

# Fixed value: default fee of a trade (a fraction; the return subtracts fee * 100 points).
DEFAULT_FEE = 0.06

TRADE_COLUMNS = [
    "exchange", "symbol", "event", "direction", "enter_price", "exit_price", "enter_time", "exit_time",
    "exit_reason", "roi_minutes", "roi_pct", "roi", "fee",
]


def trade_roi(direction: Column, enter_price: Column, exit_price: Column, fee: Column) -> Column:
    """C4: percent return of a closed trade by its *opening* direction; null otherwise."""
    long_r = F.try_divide(exit_price - enter_price, enter_price) * 100.0 - fee * 100.0
    short_r = F.try_divide(enter_price - exit_price, enter_price) * 100.0 - fee * 100.0
    ok = enter_price.isNotNull() & exit_price.isNotNull()
    return F.when(ok & (direction == LONG), long_r).when(ok & (direction == SHORT), short_r)


def accepted_signals(signals: DataFrame, keys: Sequence[str] = KEYS, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """All signals, numbered (``sig_seq``), with ``accepted``: whether the
    ledger acts on it (its kind differs from the previous signal's)."""
    keys = list(keys)
    s = signals.withColumnRenamed("seq", "bar_seq") if "seq" in signals.columns else signals.withColumn("bar_seq", F.lit(0).cast("bigint"))
    s = sequence_rows(s, keys, ["ts_ms", "bar_seq"], seq_col="sig_seq")
    s = halo_window(s, keys, lambda w: {"prev_kind": F.lag("kind", 1).over(w)}, 1, seq_col="sig_seq", chunk_rows=chunk_rows)
    return s.withColumn("accepted", F.col("kind") != F.coalesce(F.col("prev_kind"), F.lit(EXIT))).drop("prev_kind")


def trade_ledger(signals: DataFrame, fee: float = DEFAULT_FEE, literal_roi: bool = False, keys: Sequence[str] = KEYS,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """One trade event per accepted signal: ``open`` events for entries and
    ``close`` events (with the matching entry and the return) for exits."""
    keys = list(keys)
    acc = accepted_signals(signals, keys, chunk_rows)
    entered = F.col("accepted") & (F.col("kind") == ENTER)
    t = forward_fill(acc, keys, ["direction", "price", "ts_ms"], entered, seq_col="sig_seq", chunk_rows=chunk_rows, suffix="_in")
    return trade_rows(t.filter("accepted"), keys, fee, literal_roi)


def trade_rows(t: DataFrame, keys: Sequence[str] = KEYS, fee: float = DEFAULT_FEE, literal_roi: bool = False) -> DataFrame:
    """Trade events from accepted signals that carry their entry
    (``direction_in``, ``price_in``, ``ts_ms_in``): row by row, batch or stream."""
    opens, fee_c = F.col("kind") == ENTER, F.lit(float(fee))
    side = F.col("direction_in")
    closing = F.when(side == LONG, LONG_CLOSE).when(side == SHORT, SHORT_CLOSE).otherwise(side)
    roi = F.lit(None).cast("double") if literal_roi else trade_roi(side, F.col("price_in"), F.col("price"), fee_c)
    on_exit = lambda c: F.when(~opens, c)
    return t.select(
        *keys, F.when(opens, "open").otherwise("close").alias("event"), F.when(opens, side).otherwise(closing).alias("direction"),
        F.col("price_in").alias("enter_price"), on_exit(F.col("price")).alias("exit_price"), F.col("ts_ms_in").alias("enter_time"),
        F.when(opens, F.lit(0).cast("bigint")).otherwise(F.col("ts_ms")).alias("exit_time"),
        F.when(opens, F.lit(NO_REASON)).otherwise(F.col("reason")).alias("exit_reason"),
        on_exit(F.col("roi_minutes")).alias("roi_minutes"), on_exit(F.col("roi_pct")).alias("roi_pct"),
        on_exit(roi).alias("roi"), fee_c.alias("fee"),
    )

"""T5: strategies, ledger and late bars on a stream of bars.

Typed keyed state per (exchange, symbol) through ``transformWithState`` (kept
in RocksDB): value states hold the strategy's online features, its open
position with the entry it came from, and the place up to which bars were
evaluated; a list state holds the bars held back.

* Bars are evaluated in (close time, interval rank, open time) order.  A bar is
  held until the latest close time seen for its key is ``hold_ms`` past its
  own, so bars of several intervals may come in different micro-batches (up to
  that much apart) without changing the result.
* ``release_ms`` bounds that wait: a timer evaluates a key's held bars when no
  micro-batch has brought the key a bar for so long (wall clock), so the last bars of a
  feed that falls silent come out too.
* A bar at or before the place already evaluated is late or replayed: it is
  reported as a row of kind ``Late`` and never evaluated, so a replay after a
  reconnect changes nothing and no bar disappears without a trace.
* Positions are restored from an initial-state table (D4): Spark hands each
  key its row once, before the key's first bar.
* The rules are the strategy's own -- the code the batch path runs -- and any
  strategy with an ``online()`` form streams.

A micro-batch of one key is sorted in memory, so the source's rate limit
(``maxFilesPerTrigger`` and the like) bounds a task; the state does not grow
with the stream.  Queries must be started with RocksDB as the state store
(``replay.typed_state``).
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.fold import SIGNAL_FIELDS, one_bar
from ..operators.ledger import DEFAULT_FEE, trade_rows
from ..session import ship_package
from ..strategies.base import ENTER, EXIT, KEYS

LATE = "Late"
BAR_COLUMNS = ["interval_c", "interval_rank", "open_time_ms", "close_time_ms", "open", "high", "low", "close", "volume"]
Bar = namedtuple("Bar", BAR_COLUMNS)
OUT_SCHEMA = T.StructType(
    [T.StructField("exchange", T.StringType()), T.StructField("symbol", T.StringType()),
     T.StructField("seq", T.LongType()), T.StructField("ts_ms", T.LongType())]
    + [T.StructField(n, t) for n, t in SIGNAL_FIELDS]
    + [T.StructField("direction_in", T.StringType()), T.StructField("price_in", T.DoubleType()), T.StructField("ts_ms_in", T.LongType())]
)
BAR_STATE = "interval_c string, interval_rank int, open_time_ms bigint, close_time_ms bigint, open double, high double, low double, close double, volume double"
PLACE_STATE = "close_time_ms bigint, interval_rank int, open_time_ms bigint, bars bigint, top bigint"
ENTRY_STATE = [("direction_in", T.StringType()), ("price_in", T.DoubleType()), ("ts_ms_in", T.LongType())]


def _place(bar: Bar) -> tuple:
    return (bar.close_time_ms, bar.interval_rank, bar.open_time_ms)


class StrategyProcessor(StatefulProcessor):
    """One key's strategy on a stream."""

    def __init__(self, strategy, hold_ms: int, release_ms: int | None):
        self.strategy, self.hold_ms, self.release_ms = strategy, hold_ms, release_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.online = self.strategy.online()
        fields = [T.StructField(n, t) for n, t in [*self.strategy.state_fields, *ENTRY_STATE]]
        self.place = handle.getValueState("place", PLACE_STATE)
        self.features = handle.getValueState("features", self.online.schema)
        self.position = handle.getValueState("position", T.StructType(fields))
        self.held = handle.getListState("held", BAR_STATE)

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802,N803
        names = [n for n, _ in self.strategy.state_fields]
        given = next(initialState[names].astype(object).where(initialState[names].notna(), None).itertuples(index=False, name=None))
        given = tuple(v.item() if hasattr(v, "item") else v for v in given)
        if given[0] is not None:
            self.position.update((*self._typed(self.strategy.restored(given)), None, None, None))

    def _typed(self, state: tuple) -> tuple:
        kinds = {T.DoubleType: float, T.LongType: int, T.BooleanType: bool}
        return tuple(None if v is None else kinds.get(type(t), lambda x: x)(v) for v, (_, t) in zip(state, self.strategy.state_fields))

    def _late(self, key, bar: Bar) -> list:
        return [*key, None, bar.close_time_ms, LATE, None, bar.interval_c, None, None, bar.close, None, None, None]

    def _step(self, key, new: list[Bar], all_: bool) -> list[list]:
        """Evaluate what is due of the held and the new bars; ``all_``: hold nothing back."""
        rows: list[list] = []
        *done, bars, top = self.place.get() if self.place.exists() else (None, None, None, 0, None)
        done = tuple(done) if done[0] is not None else None
        before = [Bar(*b) for b in self.held.get()] if self.held.exists() else []
        waiting = list(before)
        for bar in new:
            if done is not None and _place(bar) <= done:
                rows.append(self._late(key, bar))
            else:
                waiting.append(bar)
        waiting.sort(key=_place)
        top = max([b.close_time_ms for b in waiting] + ([] if top is None else [top]), default=None)
        due = waiting if all_ else [b for b in waiting if b.close_time_ms <= top - self.hold_ms]
        held = waiting[len(due):]
        if due:
            features = self.online.unpack(self.features.get()) if self.features.exists() else self.online.new()
            size = len(self.strategy.state_fields)
            kept = self.position.get() if self.position.exists() else (None,) * (size + len(ENTRY_STATE))
            position, entry = tuple(kept[:size]), tuple(kept[size:])
            for bar in due:
                if done is not None and _place(bar) <= done:  # twice in what was held
                    rows.append(self._late(key, bar))
                    continue
                done, bars = _place(bar), bars + 1
                position, signal = one_bar(self.strategy, position, self.online.row(features, bar))
                if signal is not None:
                    if signal[0] == ENTER:
                        entry = (signal[1], signal[5], bar.close_time_ms)
                    rows.append([*key, bars, bar.close_time_ms, *signal, *entry])
            self.features.update(self.online.pack(features))
            self.position.update((*self._typed(position), *entry))
        if held != before:
            if held:
                self.held.put([tuple(b) for b in held])
            else:
                self.held.clear()
        self.place.update((*(done or (None, None, None)), bars, top))
        return rows

    def _timers(self, now: int | None) -> None:
        """One timer per key while it holds bars back."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t if isinstance(t, int) else t[0])
        if now is not None and self.held.exists():
            self.handle.registerTimer(now + self.release_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        new = [Bar(*values) for pdf in rows for values in zip(*[pdf[c].tolist() for c in BAR_COLUMNS])]
        out = self._step(key, new, False)
        if self.release_ms is not None:
            self._timers(timerValues.getCurrentProcessingTimeInMs())
        yield pd.DataFrame(out, columns=OUT_SCHEMA.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        yield pd.DataFrame(self._step(key, [], True), columns=OUT_SCHEMA.fieldNames())


def evaluate_stream(
    bars: DataFrame, strategy, hold_ms: int = 0, initial_state: DataFrame | None = None, release_ms: int | None = None,
) -> DataFrame:
    """Signals, each with the entry it belongs to, and ``Late`` rows.

    ``initial_state``: a table of positions to start from -- exchange, symbol
    and the strategy's state fields.  ``release_ms``: see the module; a query
    with it needs a trigger that goes on while the feed is silent (not
    ``availableNow``)."""
    ship_package(bars.sparkSession)
    narrow = strategy.accepted(bars).select(*KEYS, *BAR_COLUMNS)
    given = None
    if initial_state is not None:
        given = initial_state.select(*KEYS, *[F.col(n).cast(t) for n, t in strategy.state_fields]).groupBy(*KEYS)
    return narrow.groupBy(*KEYS).transformWithStateInPandas(
        StrategyProcessor(strategy, hold_ms, release_ms), OUT_SCHEMA, "Append", "None" if release_ms is None else "ProcessingTime", given)


def signals_of(evaluated: DataFrame) -> DataFrame:
    """The signals of ``evaluate_stream`` rows."""
    return evaluated.filter(F.col("kind") != LATE).select(*KEYS, "seq", "ts_ms", *[n for n, _ in SIGNAL_FIELDS])


def late_of(evaluated: DataFrame) -> DataFrame:
    """The late or replayed bars of ``evaluate_stream`` rows: key, interval, close time, close."""
    late = evaluated.filter(F.col("kind") == LATE)
    return late.select(*KEYS, F.col("reason").alias("interval"), F.col("ts_ms").alias("close_time_ms"), F.col("price").alias("close"))


def trades_of(evaluated: DataFrame, fee: float = DEFAULT_FEE, literal_roi: bool = False) -> DataFrame:
    """T3 on the stream: a strategy's signals alternate, so each is accepted,
    and an exit carries its entry."""
    return trade_rows(evaluated.filter(F.col("kind").isin(ENTER, EXIT)), KEYS, fee, literal_roi)


def stream_signals(bars: DataFrame, strategy, hold_ms: int = 0, initial_state: DataFrame | None = None, release_ms: int | None = None) -> DataFrame:
    return signals_of(evaluate_stream(bars, strategy, hold_ms, initial_state, release_ms))

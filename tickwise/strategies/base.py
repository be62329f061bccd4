"""The strategy extension point.

A strategy has two halves:

* ``features(bars, chunk_rows)`` -- Spark columns only (windows, scans,
  predicates), producing one row per bar it accepts with ``seq`` (its
  processing order per key) and ``ts_ms``;
* the rules -- entry conditions and exit rules as arrays over bars, given the
  open position -- evaluated in bounded chunks by ``run_fold`` (batch) and over
  the bars of a micro-batch by the streaming processor.

New strategies subclass ``Strategy`` and register with ``@register``.
"""

from __future__ import annotations

import dataclasses
import json
from typing import Any, ClassVar

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import snapshot as snap
from ..operators.fold import Bars, Exit, fold_series
from ..operators.series import DEFAULT_CHUNK_ROWS
from ..session import materialize

KEYS = ["exchange", "symbol"]

# Signal kinds, directions and exit reasons (enum variant names).
ENTER, EXIT = "Enter", "Exit"
LONG, SHORT, LONG_CLOSE, SHORT_CLOSE, NO_DIRECTION = "Long", "Short", "LongClose", "ShortClose", "None"
STOP_PROFIT, STOP_LOSS, TRAILING_STOP, ROI, NO_REASON = "StopProfit", "StopLoss", "TrailingStop", "Roi", "None"

REGISTRY: dict[str, type[Strategy]] = {}


def register(cls):
    REGISTRY[cls.name] = cls
    return cls


class Params:
    """Dataclass mix-in: build from a JSON document; absent keys keep defaults,
    unknown keys are ignored."""

    @classmethod
    def from_json(cls, doc: str | dict[str, Any]):
        data = json.loads(doc) if isinstance(doc, str) else dict(doc)
        names = {f.name for f in dataclasses.fields(cls)}
        return cls(**{k: v for k, v in data.items() if k in names})

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))


class Strategy:
    name: ClassVar[str] = "strategy"
    params_type: ClassVar[type] = Params
    state_fields: list[tuple[str, T.DataType]] = []
    row_columns: list[str] = []

    def __init__(self, params=None, **overrides):
        if params is None:
            params = self.params_type()
        elif isinstance(params, (str, dict)):
            params = self.params_type.from_json(params)
        if overrides:
            params = dataclasses.replace(params, **overrides)
        self.params = params

    # -- Spark half ------------------------------------------------------------------
    def features(self, bars: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS, snapshot: DataFrame | None = None) -> DataFrame:
        """One row per accepted bar; ``snapshot`` (``operators.snapshot``) is
        where the series go on from.  ``_base`` is the number of the key's
        last row in it."""
        raise NotImplementedError

    #: Name of the snapshot row that has the position.
    main_series: ClassVar[str] = "main"

    def series_ends(self, features: DataFrame, chunk_rows: int) -> DataFrame:
        """Snapshot rows of the features' series, without the position."""
        raise NotImplementedError(f"{self.name} can't be resumed")

    # -- stream half ---------------------------------------------------------------------
    def accepted(self, bars: DataFrame) -> DataFrame:
        """the bars that reach the strategy, with ``interval_c`` (canonical
        interval) and ``interval_rank`` (order of bars of one close time)."""
        raise NotImplementedError

    def online(self):
        """The strategy's features one bar at a time (``streaming.online.TypedState``):
        an object with the state's ``schema``, ``new()``, the state before any
        bar, and ``row(state, bar)``, which advances the state and returns the
        values of ``row_columns``."""
        raise NotImplementedError(f"{self.name} has no online features")

    # -- rules half (see operators.fold.FoldSpec) ---------------------------------------
    enter_kind: ClassVar[str] = ENTER
    exit_kind: ClassVar[str] = EXIT

    def entries(self, bars: Bars) -> list[tuple[str, np.ndarray]]:
        raise NotImplementedError

    def opened(self, bars: Bars, at: int, direction: str) -> tuple:
        raise NotImplementedError

    def exits(self, state: tuple, bars: Bars) -> list[Exit]:
        raise NotImplementedError

    def held(self, state: tuple, bars: Bars) -> tuple:
        return state

    def restored(self, state: tuple) -> tuple:
        return state

    #: Names of what ``bounds`` returns.
    bound_names: ClassVar[list[str]] = []

    def bars_of(self, rows: Bars) -> Bars:
        return rows

    def bounds(self, bars: Bars) -> list[float]:
        return []

    def passes(self, state: tuple, bounds: dict[str, Any]) -> tuple | None:
        """Without bounds nothing is known of a chunk: it is always evaluated."""
        return None

    # -- both ------------------------------------------------------------------------
    def signals(self, bars: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS, initial_state: DataFrame | None = None) -> DataFrame:
        feats = self.features(bars, chunk_rows)
        return fold_series(feats, KEYS, self, chunk_rows=chunk_rows, initial_state=initial_state)[0]

    def resume(self, bars: DataFrame, snapshot: DataFrame | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
        """(signals of ``bars``, the next snapshot), from the end of earlier bars.

        Only ``bars`` are read, which must come after the snapshot's
        (``snapshot.late_bars`` finds others).  Keys without new bars keep
        their place; None starts from nothing."""
        feats = materialize(self.features(bars, chunk_rows, snapshot))
        own = snap.series_of(snapshot, self.main_series)
        position = snap.values_of(own, KEYS, {n: t.simpleString() for n, t in self.state_fields})
        if position is not None:
            position = position.select(*KEYS, *[F.col(n).cast(t).alias(n) for n, t in self.state_fields])
        signals, ends = fold_series(feats, KEYS, self, chunk_rows=chunk_rows, initial_state=position, base_col="_base")
        after = self.series_ends(feats, chunk_rows)
        names = [n for n, _ in self.state_fields]
        main = F.col("series") == self.main_series
        after = snap.with_values(after.filter(main), ends, names).unionByName(after.filter(~main))
        return signals, materialize(snap.followed_by(snapshot, after))

"""Chunked evaluation of strategies.

A strategy holds at most one position per key.  It is declared, not stepped:
entry conditions and exit rules are boolean arrays over a run of bars, given
the open position, in order of precedence.  Evaluating a run therefore jumps
from trade to trade -- the first entry bar, then the first bar on which any
exit rule fires -- instead of visiting bars one by one.

A series is cut into chunks of ``chunk_rows`` rows (bounded groups):

1. every chunk is evaluated in parallel as if it began without a position, and
   summarised by the bounds of its bars (lowest and highest close, ...);
2. one pass over the chunk summaries -- one row per chunk, streamed in order --
   follows the position: a chunk that was evaluated from the state it really
   gets passes on its end state; a chunk whose bounds show that no rule can
   fire passes an open position through unevaluated; any other chunk must be
   evaluated from its real state;
3. those chunks are evaluated, all of them in one pass, and step 2 is repeated
   until no chunk is left.

Many settings of a strategy are evaluated together: each chunk's rows are read
once and every setting is evaluated on the arrays; positions, chunk ends and
bounds are kept per (key, setting).

A position held over any number of chunks costs one look at their bounds, so
the number of rounds follows the number of chunks whose result changes the
next one's, not the length of positions.  A round writes only the chunks it
evaluated.  Nothing but an emptiness test reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package
from .series import DEFAULT_CHUNK_ROWS, same_keys

SIGNAL_FIELDS = [
    ("kind", T.StringType()),
    ("direction", T.StringType()),
    ("reason", T.StringType()),
    ("roi_minutes", T.LongType()),
    ("roi_pct", T.DoubleType()),
    ("price", T.DoubleType()),
]

Signal = tuple  # (kind, direction, reason, roi_minutes, roi_pct, price)
State = tuple  # values of the state fields; all None: no position
Bars = dict[str, np.ndarray]

#: Bars looked at first after an entry; doubled until an exit is found.
FIRST_LOOK = 64


@dataclass
class Exit:
    """An exit rule over a run of bars, for one open position."""

    reason: str
    fires: np.ndarray
    roi_minutes: int | None = None
    roi_pct: float | None = None


class FoldSpec(Protocol):
    """What the engine needs from a strategy."""

    state_fields: list[tuple[str, T.DataType]]
    row_columns: list[str]
    bound_names: list[str]
    enter_kind: str
    exit_kind: str

    def entries(self, bars: Bars) -> list[tuple[str, np.ndarray]]:
        """(direction, where it may be entered), strongest first."""

    def opened(self, bars: Bars, at: int, direction: str) -> State:
        """The position entered on a bar."""

    def exits(self, state: State, bars: Bars) -> list[Exit]:
        """Exit rules for an open position, strongest first."""

    def held(self, state: State, bars: Bars) -> State:
        """The position after bars on which no rule fired."""

    def restored(self, state: State) -> State:
        """A position that was given from outside, completed."""

    def bars_of(self, rows: Bars) -> Bars:
        """The arrays that the rules read (with ``close``), from those of ``row_columns``."""

    def bounds(self, bars: Bars) -> list[float]:
        """What ``passes`` needs to know of a chunk's bars, as ``bound_names``; NaN where a bar has none."""

    def passes(self, state: State, bounds: dict[str, Any]) -> State | None:
        """The position after a chunk with these bounds if surely no rule fires there, else None."""


def evaluate(spec: FoldSpec, state: State, bars: Bars) -> tuple[list[tuple[int, Signal]], State]:
    """Signals (row, signal) of a run of bars that begins in ``state``, and the state it ends in."""
    rows = len(bars["close"])
    flat = (None,) * len(spec.state_fields)
    ways = spec.entries(bars)
    entry_rows = np.flatnonzero(np.logical_or.reduce([where for _, where in ways])) if rows else np.zeros(0, int)
    close, out, at, look = bars["close"], [], 0, FIRST_LOOK
    while at < rows:
        if state[0] is None:
            n = int(np.searchsorted(entry_rows, at))
            if n == len(entry_rows):
                break
            at = int(entry_rows[n])
            direction = next(d for d, where in ways if where[at])
            out.append((at, (spec.enter_kind, direction, None, None, None, float(close[at]))))
            state, at, look = spec.opened(bars, at, direction), at + 1, FIRST_LOOK
            continue
        run = {c: v[at : at + look] for c, v in bars.items()}
        rules = spec.exits(state, run)
        fired = np.logical_or.reduce([r.fires for r in rules])
        if not fired.any():
            state, at, look = spec.held(state, run), at + len(fired), look * 2
            continue
        first = int(fired.argmax())
        rule = next(r for r in rules if r.fires[first])
        at += first
        out.append((at, (spec.exit_kind, None, rule.reason, rule.roi_minutes, rule.roi_pct, float(close[at]))))
        state, at = flat, at + 1
    return out, state


def _array(column: pa.Array) -> np.ndarray:
    """Numbers with null as NaN, booleans with null as False."""
    if pa.types.is_boolean(column.type):
        return column.fill_null(False).to_numpy(zero_copy_only=False)
    return column.to_numpy(zero_copy_only=False)


def _chunk_evaluator(specs: Sequence[FoldSpec], keys: list[str], seq_col: str, ts_col: str, out_schema: T.StructType, again: bool):
    """Per-partition pass over rows sorted by (key, chunk, seq): evaluate each
    chunk -- under every setting from no position, or (``again``) under the
    setting and from the state on its first row; emit its signals and one
    ``end`` row a setting."""
    fields = specs[0].state_fields
    in_cols = [f"in_{n}" for n, _ in fields]
    blank_state, blank_bounds = [None] * len(in_cols), [None] * len(specs[0].bound_names)
    blank_signal = [None] * len(SIGNAL_FIELDS)
    columns = list(dict.fromkeys(c for s in specs for c in s.row_columns))
    schema = None

    def chunk(parts: list[pa.RecordBatch]) -> list[list]:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: table.column(c).chunk(0)
        head = [column(c)[0].as_py() for c in [*keys, "_chunk"]]
        rows = {c: _array(column(c)) for c in columns}
        seq, ts, out = column(seq_col), column(ts_col), []
        for setting in [column("_setting")[0].as_py()] if again else range(len(specs)):
            spec = specs[setting]
            state = tuple(column(c)[0].as_py() for c in in_cols) if again else (None,) * len(in_cols)
            start = spec.restored(state) if state[0] is not None else (None,) * len(state)
            bars = spec.bars_of(rows)
            found, end = evaluate(spec, start, bars)
            out += [[*head, setting, "sig", seq[i].as_py(), ts[i].as_py(), *s, *blank_state, *blank_state, *blank_bounds] for i, s in found]
            out.append([*head, setting, "end", None, None, *blank_signal, *end, *start, *map(float, spec.bounds(bars))])
        return out

    def run(batches):
        nonlocal schema
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = schema or to_arrow_schema(out_schema)
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            begins = np.flatnonzero(batch.column(batch.schema.get_field_index("_pos")).to_numpy() == 0)
            rows: list[list] = []
            cuts = [0, *begins.tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo in begins and parts:
                    rows += chunk(parts)
                    parts = []
                if hi > lo:
                    parts.append(batch.slice(lo, hi - lo))
            if rows:
                yield _batch(rows, schema)
        if parts:
            yield _batch(chunk(parts), schema)

    return run


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _follower(specs: Sequence[FoldSpec], keys: list[str], out_schema: T.StructType):
    """Per-partition pass over chunk ends sorted by (key, setting, chunk,
    round): what each chunk's real start state is, which evaluation holds for
    it, and the state after it."""
    names = [n for n, _ in specs[0].state_fields]
    bound_names = specs[0].bound_names
    flat = (None,) * len(names)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out_schema)
        place, state, chunk, known, summary = None, flat, None, [], None

        def settle():
            """The chunk in hand: (row for it, state after it)."""
            for start, end, number in known:
                if start == state:
                    return [*place, chunk, number, False, *state, *end], end
            after = specs[place[-1]].passes(state, summary) if state[0] is not None else None
            if after is not None:
                return [*place, chunk, None, False, *state, *after], after
            return [*place, chunk, None, True, *state, *known[-1][1]], known[-1][1]  # go on with the latest guess

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                here = tuple(r[k] for k in [*keys, "_setting"])
                if (here, r["_chunk"]) != (place, chunk):
                    if place is not None:
                        row, state = settle()
                        rows.append(row)
                    if here != place:
                        given = tuple(r[f"given_{n}"] for n in names)
                        state = specs[here[-1]].restored(given) if given[0] is not None else flat
                    place, chunk, known, summary = here, r["_chunk"], [], {b: r[f"b_{b}"] for b in bound_names}
                known.append((tuple(r[f"in_{n}"] for n in names), tuple(r[f"out_{n}"] for n in names), r["_round"]))
            if rows:
                yield _batch(rows, schema)
        if place is not None:
            yield _batch([settle()[0]], schema)

    return run


def fold_series(
    features: DataFrame,
    keys: Sequence[str],
    spec: FoldSpec | Sequence[FoldSpec],
    seq_col: str = "seq",
    ts_col: str = "ts_ms",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    initial_state: DataFrame | None = None,
    base_col: str | None = None,
    setting_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Evaluate ``spec`` over each key's rows in ``seq`` order; return the
    signals, and the state each key ends in (keys and the state fields).

    ``seq_col`` numbers the rows of a key 1, 2, 3, ..., or on from ``base_col``.
    ``initial_state`` (optional): keys plus the state fields, the position each
    key starts with.  Several specs are settings of one strategy (the same
    state fields and bounds); ``setting_col`` then names the column with their
    number.
    """
    keys = list(keys)
    specs = list(spec) if isinstance(spec, Sequence) else [spec]
    fields, names = specs[0].state_fields, [n for n, _ in specs[0].state_fields]
    ship_package(features.sparkSession)
    needed = list(dict.fromkeys([*keys, seq_col, ts_col, *[c for s in specs for c in s.row_columns]]))
    place = F.col(seq_col) - 1 if base_col is None else F.col(seq_col) - F.col(base_col) - 1
    chunk, pos = F.floor(place / F.lit(chunk_rows)).cast("bigint"), (place % F.lit(chunk_rows)).cast("bigint")
    feats = materialize(features.select(*needed, chunk.alias("_chunk"), pos.alias("_pos")))
    at = [*[feats.schema[k] for k in keys]]
    setting, number_ = T.StructField("_setting", T.IntegerType()), T.StructField("_chunk", T.LongType())
    state_of = lambda p: [T.StructField(f"{p}_{n}", t) for n, t in fields]
    out_schema = T.StructType(
        [*at, number_, setting, T.StructField("_rtype", T.StringType()), T.StructField(seq_col, T.LongType()), T.StructField(ts_col, T.LongType())]
        + [T.StructField(n, t) for n, t in SIGNAL_FIELDS] + state_of("out") + state_of("in")
        + [T.StructField(f"b_{n}", T.DoubleType()) for n in specs[0].bound_names]
    )

    def evaluated(rows: DataFrame, number: int) -> DataFrame:
        by = [*keys, "_setting", "_chunk"] if number else [*keys, "_chunk"]
        clustered = rows.repartition(*by).sortWithinPartitions(*by, seq_col)
        run = _chunk_evaluator(specs, keys, seq_col, ts_col, out_schema, again=number > 0)
        return materialize(clustered.mapInArrow(run, out_schema).withColumn("_round", F.lit(number).cast("bigint")))

    results = evaluated(feats, 0)
    given = [F.lit(None).cast(t).alias(f"given_{n}") for n, t in fields]
    if initial_state is not None:  # met by a key's first chunk only
        first = initial_state.select(*keys, F.lit(0).cast("bigint").alias("_chunk"), *[F.col(n).cast(t).alias(f"given_{n}") for n, t in fields])
        given = [f"given_{n}" for n in names]

    follow_schema = T.StructType(
        [*at, setting, number_, T.StructField("_use", T.LongType()), T.StructField("_need", T.BooleanType()), *state_of("in"), *state_of("after")]
    )
    follower = _follower(specs, keys, follow_schema)
    number = 0
    while True:
        ends = results.filter(F.col("_rtype") == "end")
        if initial_state is not None:
            ends = same_keys(ends, first, [*keys, "_chunk"], "left")
        rows = ends.select(*keys, "_setting", "_chunk", "_round", *[f"{p}_{n}" for n in names for p in ("in", "out")],
                           *[f"b_{n}" for n in specs[0].bound_names], *given)
        followed = rows.repartition(*keys, "_setting").sortWithinPartitions(*keys, "_setting", "_chunk", "_round").mapInArrow(follower, follow_schema)
        followed = materialize(followed)
        need = followed.filter("_need").select(*keys, "_setting", "_chunk", *[f"in_{n}" for n in names])
        if need.isEmpty():
            break
        number += 1
        results = results.unionByName(evaluated(same_keys(feats, need, [*keys, "_chunk"]), number))

    used = followed.filter(F.col("_use").isNotNull()).select(*keys, "_setting", "_chunk", F.col("_use").alias("_round"))
    signals = same_keys(results.filter(F.col("_rtype") == "sig"), used, [*keys, "_setting", "_chunk", "_round"])
    last = followed.groupBy(*keys, "_setting").agg(F.max_by(F.struct(*[f"after_{n}" for n in names]), "_chunk").alias("s"))
    shown = [] if setting_col is None else [F.col("_setting").alias(setting_col)]
    ends = last.select(*keys, *shown, *[F.col(f"s.after_{n}").alias(n) for n in names])
    return signals.select(*keys, *shown, seq_col, ts_col, *[n for n, _ in SIGNAL_FIELDS]), ends


def run_fold(features: DataFrame, keys: Sequence[str], spec: FoldSpec, **options) -> DataFrame:
    """The signals of ``fold_series``."""
    return fold_series(features, keys, spec, **options)[0]


def one_bar(spec: FoldSpec, state: State, row: Sequence) -> tuple[State, Signal | None]:
    """Evaluate a single bar (values of ``row_columns``)."""
    bars = {c: np.array([np.nan if v is None else v]) for c, v in zip(spec.row_columns, row)}
    found, end = evaluate(spec, state, spec.bars_of(bars))
    return end, found[0][1] if found else None


def sequential_fold(rows: Sequence[tuple], spec: FoldSpec, state: State | None = None) -> list[tuple[int, Signal]]:
    """One key's rows bar by bar (tests): [(row position, signal)]."""
    state = (None,) * len(spec.state_fields) if state is None else spec.restored(state)
    out = []
    for i, row in enumerate(rows):
        state, sig = one_bar(spec, state, row)
        if sig is not None:
            out.append((i, sig))
    return out

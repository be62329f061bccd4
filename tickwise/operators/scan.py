"""Chunked parallel affine scan  y_t = a_t * y_{t-1} + b_t  (y_0 = 0).

A recurrence may also read the previous values of other recurrences of the
same scan (``feeds``):  y_t = a_t * y_{t-1} + b_t + sum_j f_{j,t} * y_{j,t-1},
which is how the MACD signal line follows both averages.

Spark has no recursive window.  Such maps compose into maps of the same form,
so a series is cut into chunks of ``chunk_rows`` rows and scanned in two passes:

1. per chunk, one row: the chunk as one map -- the product of its coefficients,
   its end value when started from 0, and what a carry of 1 in each fed
   recurrence adds to it;
2. the carry into every chunk is the scan of those maps -- the same problem on
   a table ``chunk_rows`` times smaller, solved by recursion, whatever the
   length of the series -- and a second pass starts each chunk at its carry
   and returns the rows with their columns.

Both passes stream over rows clustered by (key, chunk) and read the input from
one written table, so what is upstream runs once; or they follow an operator that
dealt the rows by (key, chunk), without a write or shuffle of their own.
Coefficients are made from a row's columns after the shuffle.  Within an Arrow
batch the recurrences of all chunks advance together by numpy doubling steps; a
task holds one batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package
from .series import DEFAULT_CHUNK_ROWS, same_keys


@dataclass
class Affine:
    """One recurrence: output column ``name`` with coefficients ``a`` and ``b``,
    and of the previous values of recurrences before it, ``feeds``."""

    name: str
    a: Column
    b: Column
    feeds: dict[str, Column] = field(default_factory=dict)


@dataclass
class _Layout:
    """Names of a scan's recurrences and its (fed, feeding) pairs by position."""

    names: list[str]
    pairs: list[tuple[int, int]]

    def coefficients(self) -> list[str]:
        return [f"_{p}_{n}" for p in ("ca", "cb") for n in self.names] + [f"_cf_{self.names[i]}_{self.names[j]}" for i, j in self.pairs]

    def maps(self) -> list[str]:
        return [f"_{p}_{n}" for p in ("pa", "ly") for n in self.names] + [f"_pf_{self.names[i]}_{self.names[j]}" for i, j in self.pairs]


def scan_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The recurrence down the rows of a block, one column per series, from 0.

    A zero coefficient starts a new series.  Doubling: after step d every row
    covers the 2d rows up to it."""
    a, y, d = a.copy(), b.copy(), 1
    while d < len(a) and a[d:].any():
        # 0 * inf must not leak into another series.
        y[d:] += np.where(a[d:] == 0, 0.0, a[d:] * y[:-d])
        a[d:] = np.where(a[d:] == 0, 0.0, a[d:] * a[:-d])
        d *= 2
    return y


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    found = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
    return np.stack(found, axis=1).astype(float) if found else np.zeros((batch.num_rows, 0))


def _solve(layout: _Layout, a: np.ndarray, b: np.ndarray, f: np.ndarray, begins: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Values of all recurrences on rows whose runs begin at ``begins`` from
    the values in ``start`` (one row per run)."""
    y, inner = np.empty_like(b), a.copy()
    inner[begins] = 0.0
    for i in range(len(layout.names)):
        b_i = b[:, i].copy()
        b_i[begins] += np.where(a[begins, i] == 0, 0.0, a[begins, i] * start[:, i])
        for n, (fed, j) in enumerate(layout.pairs):
            if fed == i:
                before = np.concatenate(([0.0], y[:-1, j]))
                before[begins] = start[:, j]
                b_i += np.where(f[:, n] == 0, 0.0, f[:, n] * before)
        y[:, i] = scan_block(inner[:, i : i + 1], b_i[:, None])[:, 0]
    return y


def _chunk_maps(layout: _Layout, keep: list[str]):
    """Pass 1: one row per chunk, the chunk as one map."""
    size, pairs = len(layout.names), layout.pairs

    def responses(a, f, begins, product, added):
        """Running products, and running effects of a carry of 1 in each feeding recurrence."""
        products = _solve(_Layout(layout.names, []), a, np.zeros_like(a), f, begins, product)
        effects = np.zeros((len(a), len(pairs)))
        for n, (i, j) in enumerate(pairs):
            before = np.concatenate(([0.0], products[:-1, j]))
            before[begins] = product[:, j]
            one = _Layout([layout.names[i]], [])
            effects[:, n] = _solve(one, a[:, i : i + 1], (f[:, n] * before)[:, None], f, begins, added[:, n : n + 1])[:, 0]
        return products, effects

    def finished(rows: pa.RecordBatch, maps: np.ndarray) -> pa.RecordBatch:
        kept = [rows.column(rows.schema.get_field_index(c)) for c in keep]
        return pa.RecordBatch.from_arrays([*kept, *[pa.array(np.ascontiguousarray(x)) for x in maps.T]], [*keep, *layout.maps()])

    def run(batches):
        held = None  # last row so far of the chunk in hand, and its map
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column(batch.schema.get_field_index("_pos")).to_numpy() == 0
            every = _columns(batch, layout.coefficients())
            a, b, f = every[:, :size], every[:, size : 2 * size], every[:, 2 * size :]
            begins = np.flatnonzero(first) if first[0] else np.concatenate(([0], np.flatnonzero(first)))
            product, start, added = np.ones((len(begins), size)), np.zeros((len(begins), size)), np.zeros((len(begins), len(pairs)))
            if not first[0]:
                product[0], start[0], added[0] = held[1][:size], held[1][size : 2 * size], held[1][2 * size :]
            elif held is not None:
                yield finished(held[0], held[1][None])
            y = _solve(layout, a, b, f, begins, start)
            products, effects = responses(a, f, begins, product, added)
            ends = np.append(begins[1:] - 1, batch.num_rows - 1)
            maps = np.concatenate([products, y, effects], axis=1)[ends]
            if len(ends) > 1:
                yield finished(batch.take(pa.array(ends[:-1])), maps[:-1])
            held = (batch.slice(int(ends[-1]), 1), maps[-1])
        if held is not None:
            yield finished(held[0], held[1][None])

    return run


def _chunk_values(layout: _Layout, keep: list[str]):
    """Pass 2: every row with its scanned values, each chunk started at its carry."""
    size = len(layout.names)

    def run(batches):
        last = np.zeros(size)
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column(batch.schema.get_field_index("_pos")).to_numpy() == 0
            every = _columns(batch, [*layout.coefficients(), *[f"_carry_{n}" for n in layout.names]])
            a, b, f, carry = np.split(every, [size, 2 * size, every.shape[1] - size], axis=1)
            begins = np.flatnonzero(first) if first[0] else np.concatenate(([0], np.flatnonzero(first)))
            start = carry[begins]
            if not first[0]:
                start[0] = last
            y = _solve(layout, a, b, f, begins, start)
            last = y[-1]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(np.ascontiguousarray(x)) for x in y.T]], [*keep, *layout.names])

    return run


def affine_scan(
    df: DataFrame,
    keys: Sequence[str],
    specs: Sequence[Affine],
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    base_col: str | None = None,
    initial: DataFrame | None = None,
    chunk_col: str | None = None,
) -> DataFrame:
    """Add one column per spec holding the scanned value ``y_t``.

    ``seq_col`` numbers the rows of each key 1, 2, 3, ... without gaps; with
    ``base_col`` they begin after that number, and ``initial`` (keys and one
    column per spec) has the values there, 0 for a key without a row.  The
    only thing the driver learns is the largest chunk number.

    ``chunk_col`` says that ``df`` already has its rows dealt by (keys, that
    column), the number of a chunk of ``chunk_rows`` as ``halo_window`` keeps it:
    ``df`` is then neither written nor shuffled but computed in both passes.  Its
    keys must not be null (a struct of what may be)."""
    keys, names = list(keys), [s.name for s in specs]
    layout = _Layout(names, [(i, names.index(j)) for i, s in enumerate(specs) for j in s.feeds])
    if chunk_col is None:
        chunk_rows = max(chunk_rows, 2)  # every level is at most half as long as the one below
    ship_package(df.sparkSession)
    coef = [s.a for s in specs] + [s.b for s in specs] + [c for s in specs for c in s.feeds.values()]
    coefficients = [c.cast("double").alias(n) for c, n in zip(coef, layout.coefficients())]
    place = F.col(seq_col) - 1 if base_col is None else F.col(seq_col) - F.col(base_col) - 1
    chunk = F.floor(place / F.lit(chunk_rows)).cast("bigint") if chunk_col is None else F.col(chunk_col)
    t = df.select("*", *([] if chunk_col == "_chunk" else [chunk.alias("_chunk")]), (place % F.lit(chunk_rows)).cast("bigint").alias("_pos"))
    if chunk_col is None:
        t = materialize(t)  # read by both passes: computed once

    def clustered(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(*keys, "_chunk") if chunk_col is None else rows
        return dealt.sortWithinPartitions(*keys, "_chunk", seq_col)

    carry = None  # (keys, _chunk, value before the chunk)
    if initial is not None:
        carry = initial.select(*keys, F.lit(0).cast("bigint").alias("_chunk"), *[F.col(n).cast("double").alias(f"_carry_{n}") for n in names])
    if t.agg(F.max("_chunk")).first()[0]:
        keep = [*keys, "_chunk"]
        schema = T.StructType([t.schema[c] for c in keep] + [T.StructField(n, T.DoubleType()) for n in layout.maps()])
        maps = clustered(t).select(*keep, "_pos", *coefficients).mapInArrow(_chunk_maps(layout, keep), schema)
        maps = maps.withColumn("_cseq", F.col("_chunk") + 1).drop("_chunk")
        level = [
            Affine(f"_end_{s.name}", F.col(f"_pa_{s.name}"), F.col(f"_ly_{s.name}"), {f"_end_{j}": F.col(f"_pf_{s.name}_{j}") for j in s.feeds})
            for s in specs
        ]
        first = None if initial is None else initial.select(*keys, *[F.col(n).alias(f"_end_{n}") for n in names])
        ends = affine_scan(maps, keys, level, "_cseq", chunk_rows, initial=first)
        # The end of a chunk is the carry into the next one.
        ends = ends.select(*keys, F.col("_cseq").alias("_chunk"), *[F.col(f"_end_{n}").alias(f"_carry_{n}") for n in names])
        carry = ends if carry is None else ends.unionByName(carry)
    carries = [F.lit(0.0).alias(f"_carry_{n}") for n in names]
    if carry is not None:
        # Plain equality keeps rows where they were dealt.
        t = same_keys(t, carry, [*keys, "_chunk"], "left") if chunk_col is None else t.join(carry, [*keys, "_chunk"], "left")
        carries = [F.coalesce(f"_carry_{n}", F.lit(0.0)).alias(f"_carry_{n}") for n in names]
    keep = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    return clustered(t).select(*keep, "_pos", *coefficients, *carries).mapInArrow(_chunk_values(layout, keep), schema)


def sequential_affine(a: Sequence[float], b: Sequence[float]) -> list[float]:
    """The plain left-to-right recurrence (tests)."""
    y, out = 0.0, []
    for at, bt in zip(a, b):
        y = at * y + bt
        out.append(y)
    return out

"""Series layout: exact per-key row numbers and chunked evaluation.

A bar series is ordered per key (exchange, symbol[, interval]).  The naive
Spark form, ``Window.partitionBy(symbol).orderBy(time)``, sends a whole
symbol to one task; a symbol holding a third of the data would then be a
third of the job in one task.  Everything here works on bounded groups
instead:

* ``sequence``  numbers rows per key through time buckets: a row number
  inside each (key, bucket) plus a running offset of bucket sizes, which is
  computed on the small per-bucket count table.
* ``sequence_rows`` does the same when no time slot bounds the rows: rows are
  range-partitioned by (key, order) and numbered within their partition.
* offsets and carries over the per-bucket or per-chunk tables are themselves
  taken in two levels (``carried``), so no window holds more than a thousandth
  of a table that is a thousandth of the series.
* ``halo_window`` evaluates window expressions whose frame reaches at most
  ``halo`` rows back: each chunk gets a copy of the previous chunk's last
  ``halo`` rows, the window runs per (key, chunk), and the copies are
  dropped.  Exact for any frame of width <= halo + 1.
* ``prefix_sum`` and ``forward_fill`` are running aggregates over the whole
  series: a chunk-local window plus a carry from the small per-chunk table.

A null in a key is a value like any other: its rows are one series.  Series can
go on from where an earlier table ended (``start``, ``initial``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

DEFAULT_CHUNK_ROWS = 1024


#: One column for a row's keys: a struct, which is equal to another when its nulls are, too.
_KEY = "_key"


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(_KEY, F.struct(*keys))


def same_keys(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` in which nulls equal each other."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in on else c) for c in right.columns])
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, equal, how).drop(*[f"_r_{c}" for c in on])


def sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: Column,
    seq_col: str = "seq",
    start: DataFrame | None = None,
    base_col: str | None = None,
    counted_first: bool = False,
) -> DataFrame:
    """Add a 1-based row number per key in ``order``.

    ``bucket`` must be non-decreasing along ``order`` within a key (e.g. a
    coarse slot of the first order column) and bound the rows per (key,
    bucket).  ``start`` (keys and ``seq_col``: the last number given out by an
    earlier table) goes on from there; ``base_col`` adds that number, or 0, to
    the rows.  ``counted_first`` writes the offsets, one row per (key, bucket),
    at once: rows that lie anywhere give as many counts to shuffle, and these are
    then gone when the rows are shuffled.
    """
    # Only the struct of the keys is shuffled with the rows.
    b = _keyed(df, keys).withColumn("_bkt", bucket).drop(*keys)
    local = b.withColumn("_loc", F.row_number().over(Window.partitionBy(_KEY, "_bkt").orderBy(*order)))
    counts = b.groupBy(_KEY, "_bkt").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = carried(counts, [_KEY], "_bkt", {"_off": ("sum", "_cnt")})
    if start is None:
        offsets = offsets.withColumn("_base", F.lit(0).cast("bigint"))
    else:
        begun = _keyed(start, keys).select(_KEY, F.col(seq_col).alias("_base"))
        offsets = offsets.join(begun, _KEY, "left").withColumn("_base", F.coalesce("_base", F.lit(0).cast("bigint")))
    if counted_first:
        offsets = materialize(offsets)
    out = local.join(offsets, [_KEY, "_bkt"]).withColumn(seq_col, (F.col("_base") + F.col("_off") + F.col("_loc")).cast("bigint"))
    shown = {c: F.col(f"{_KEY}.{c}") if c in keys else F.col(c) for c in df.columns} | {seq_col: F.col(seq_col)}
    if base_col is not None:
        shown[base_col] = F.col("_base")
    return out.select(*[v.alias(c) for c, v in shown.items()])


#: Positions per group of the first carry level.
CARRY_GROUP = 1024


def carried(table: DataFrame, keys: Sequence[str], position: str, values: dict[str, tuple[str, str]]) -> DataFrame:
    """(keys, position, one column per value): for each row of a table with one
    row per (key, whole position), the ``sum`` (0 if none) or the ``last``
    non-null value of a column over all rows of the key at smaller positions.

    Two levels: within groups of ``CARRY_GROUP`` positions, and over the
    groups' totals."""
    keys = list(keys)
    t = table.withColumn("_group", F.floor(F.col(position) / F.lit(CARRY_GROUP)))

    def before(order: str) -> Callable[[list[str]], WindowSpec]:
        return lambda by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def total(how: str, c: Column | str, w: WindowSpec) -> Column:
        return F.sum(c).over(w) if how == "sum" else F.last(c, ignorenulls=True).over(w)

    inner = before(position)([*keys, "_group"])
    local = t.select(*keys, position, "_group", *[total(how, c, inner).alias(f"_in_{n}") for n, (how, c) in values.items()])
    whole = {
        n: F.sum(c) if how == "sum" else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(position))) for n, (how, c) in values.items()
    }
    groups = t.groupBy(*keys, "_group").agg(*[e.alias(f"_all_{n}") for n, e in whole.items()])
    outer = before("_group")(keys)
    groups = groups.select(*keys, "_group", *[total(how, f"_all_{n}", outer).alias(f"_out_{n}") for n, (how, _) in values.items()])

    def both(n: str, how: str) -> Column:
        inside, outside = F.col(f"_in_{n}"), F.col(f"_out_{n}")
        return F.coalesce(inside, outside) if how == "last" else F.coalesce(inside, F.lit(0)) + F.coalesce(outside, F.lit(0))

    return same_keys(local, groups, [*keys, "_group"]).select(*keys, position, *[both(n, how).alias(n) for n, (how, _) in values.items()])


def sequence_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], seq_col: str = "seq") -> DataFrame:
    """Add a 1-based row number per key in ``order``, with groups bounded by rows.

    Rows are range-partitioned by (keys, order): a key with any share of the
    rows is spread over as many partitions.  Each partition numbers its rows
    per key; a key's offset is the count of its rows in earlier partitions (one
    row per key and partition).  The numbered rows are written once, because
    both the counts and the rows depend on where the partitions were cut."""
    keys = list(keys)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            place = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            change = np.concatenate(([False], _changes(batch, keys)))
            change[0] = held is None or held != tuple(c[0].as_py() for c in place)
            at = np.arange(batch.num_rows)
            begin = np.maximum.accumulate(np.where(change, at, -1))
            local = np.where(begin < 0, at + count, at - begin) + 1
            held, count = tuple(c[-1].as_py() for c in place), int(local[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(local)], [*batch.schema.names, "_part", "_loc"]
            )

    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_loc", T.LongType())])
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    local = materialize(dealt.mapInArrow(number, schema))
    local = _keyed(local, keys)
    counts = local.groupBy(_KEY, "_part").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = carried(counts, [_KEY], "_part", {"_off": ("sum", "_cnt")})
    return local.join(offsets, [_KEY, "_part"]).withColumn(seq_col, (F.col("_off") + F.col("_loc")).cast("bigint")).drop(_KEY, "_part", "_loc", "_off")


def _changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """For every row but the first: whether its keys differ from the row before."""
    out = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in keys:
        c = batch.column(batch.schema.get_field_index(k))
        null = c.is_null().to_numpy(zero_copy_only=False)
        differ = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)), False).to_numpy(zero_copy_only=False)
        out |= np.where(null[1:] | null[:-1], null[1:] != null[:-1], differ)
    return out


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    """Add ``name``: ``column`` of the key's next row in ``order``, null on its last.

    One sort by range of (keys, order), whatever a key's share of the rows;
    a range's last row looks at the first row of the next range, a table of one
    row per range.  The rows are written once."""
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, True

        def made(rows: pa.RecordBatch, following: pa.Array, last: bool) -> pa.RecordBatch:
            nonlocal first
            begins, n = np.zeros(rows.num_rows, bool), rows.num_rows
            begins[0], first = first, False
            more = [following, pa.array(np.full(n, part)), pa.array(begins), pa.array(np.full(n, last))]
            return pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, name, "_part", "_first", "_last"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            if n > 1:
                values = batch.column(batch.schema.get_field_index(column)).slice(1)
                yield made(batch.slice(0, n - 1), pc.if_else(pa.array(_changes(batch, keys)), pa.scalar(None, values.type), values), False)
            held = batch.slice(n - 1, 1)
        if held is not None:
            yield made(held, pa.nulls(1, held.column(held.schema.get_field_index(column)).type), True)

    more = [T.StructField(name, df.schema[column].dataType), T.StructField("_part", T.LongType()), T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())]
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = _keyed(materialize(dealt.mapInArrow(run, T.StructType([*df.schema.fields, *more]))), keys)
    over = Window.orderBy("_part")  # one row per range
    firsts = rows.where("_first").select("_part", F.struct(_KEY, F.col(column).alias("_v")).alias("_f")).select("_part", F.lead("_f").over(over).alias("_f"))
    # Every range that has a last row has a first row: one per range each.
    ends = rows.where("_last").drop(name).join(firsts, "_part").withColumn(name, F.when(F.col("_f._key") == F.col(_KEY), F.col("_f._v")))
    return rows.where("NOT _last").select(*df.columns, name).unionByName(ends.select(*df.columns, name))


def chunk_expr(seq_col: str, chunk_rows: int) -> Column:
    return F.floor((F.col(seq_col) - 1) / F.lit(chunk_rows)).cast("bigint")


def halo_window(
    df: DataFrame,
    keys: Sequence[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    halo: int,
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    ahead: int = 0,
    chunk_col: str | None = None,
) -> DataFrame:
    """Evaluate ``build(w)`` (window expressions over ``w``) per chunk plus halo.

    ``w`` is ``partitionBy(keys, chunk).orderBy(seq)``; expressions may look
    back at most ``halo`` rows (``rowsBetween(-halo, 0)``, ``lag(x, halo)``)
    and forward at most ``ahead`` rows (``lead(x, ahead)``).  ``build`` may
    return a list of dicts, evaluated in order; the look-backs of the stages
    then add up and must stay within ``halo``.  ``chunk_col`` keeps the chunk's
    number, by which (and the keys) the rows returned are dealt.
    """
    keys = list(keys)
    pos = (F.col(seq_col) - 1) % F.lit(chunk_rows)
    # A row is copied into every later chunk whose first row lies at most
    # ``halo`` rows after it, and every earlier chunk whose last row lies at
    # most ``ahead`` rows before it (one chunk each way when <= chunk_rows).
    later = F.floor((F.lit(halo) + pos) / F.lit(chunk_rows)).cast("bigint")
    earlier = F.greatest(F.floor((F.lit(ahead - 1 + chunk_rows) - pos) / F.lit(chunk_rows)), F.lit(0)).cast("bigint")
    shifts = F.sequence(-earlier, later) if ahead > 0 else F.sequence(F.lit(0).cast("bigint"), later)
    copies = (
        df.withColumn("_shift", F.explode(shifts))
        .withColumn("_wchunk", chunk_expr(seq_col, chunk_rows) + F.col("_shift"))
    )
    w = Window.partitionBy(*keys, "_wchunk").orderBy(seq_col)
    stages = build(w)
    out = copies
    # Several stages (later ones may use earlier results) share one partitioning
    # and order, so they plan as consecutive Window operators without a new shuffle.
    for exprs in (stages if isinstance(stages, list) else [stages]):
        out = out.select("*", *[e.alias(name) for name, e in exprs.items()])
    out = out.filter(F.col("_shift") == 0).drop("_shift")
    return out.drop("_wchunk") if chunk_col is None else out.withColumnRenamed("_wchunk", chunk_col)


def prefix_sum(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Running (inclusive) sums of ``values`` over the whole series of each key.

    ``initial`` (keys and one column per value): sums reached by an earlier table."""
    names = list(values)
    t = _keyed(df, keys).withColumn("_chunk", chunk_expr(seq_col, chunk_rows))
    for n, v in values.items():
        t = t.withColumn(f"_v_{n}", v)
    w = Window.partitionBy(_KEY, "_chunk").orderBy(seq_col).rowsBetween(Window.unboundedPreceding, 0)
    local = t.select("*", *[F.sum(f"_v_{n}").over(w).alias(f"_l_{n}") for n in names])
    totals = t.groupBy(_KEY, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    carry = carried(totals, [_KEY], "_chunk", {f"_c_{n}": ("sum", f"_t_{n}") for n in names})
    if initial is not None:
        before = _keyed(initial, keys).select(_KEY, *[F.col(n).alias(f"_i_{n}") for n in names])
        carry = carry.join(before, _KEY, "left").select(
            _KEY, "_chunk", *[(F.col(f"_c_{n}") + F.coalesce(f"_i_{n}", F.lit(0))).alias(f"_c_{n}") for n in names])
    out = local.join(carry, [_KEY, "_chunk"])
    for n in names:
        out = out.withColumn(n, F.col(f"_l_{n}") + F.col(f"_c_{n}"))
    return out.drop(_KEY, "_chunk", *[f"_{p}_{n}" for p in "vlc" for n in names])


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    present: Column,
    seq_col: str = "seq",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    suffix: str = "_asof",
    initial: DataFrame | None = None,
) -> DataFrame:
    """For each row, the values of ``cols`` on the latest row at or before it
    where ``present`` holds (as-of carry over the whole series).

    ``initial`` (keys and ``cols``): values carried by an earlier table."""
    cols = list(cols)
    t = _keyed(df, keys).withColumn("_chunk", chunk_expr(seq_col, chunk_rows)).withColumn("_has", present)
    packed = F.when(F.col("_has"), F.struct(*[F.col(c).alias(c) for c in cols]))
    t = t.withColumn("_pk", packed)
    w = Window.partitionBy(_KEY, "_chunk").orderBy(seq_col).rowsBetween(Window.unboundedPreceding, 0)
    local = t.withColumn("_loc", F.last("_pk", ignorenulls=True).over(w))
    there = F.when(F.col("_has"), F.col(seq_col))
    table = t.groupBy(_KEY, "_chunk").agg(F.max_by("_pk", there).alias("_lastpk"))
    carry = carried(table, [_KEY], "_chunk", {"_carry": ("last", "_lastpk")})
    if initial is not None:
        before = _keyed(initial, keys).select(_KEY, F.struct(*[F.col(c).alias(c) for c in cols]).alias("_before"))
        carry = carry.join(before, _KEY, "left").select(_KEY, "_chunk", F.coalesce("_carry", "_before").alias("_carry"))
    out = local.join(carry, [_KEY, "_chunk"]).withColumn("_val", F.coalesce("_loc", "_carry"))
    for c in cols:
        out = out.withColumn(c + suffix, F.col("_val")[c])
    return out.drop(_KEY, "_chunk", "_has", "_pk", "_loc", "_carry", "_val")

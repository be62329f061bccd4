"""Series that go on where an earlier run ended.

A snapshot is a small table, one row per key and series (a strategy may keep
several, e.g. one per timeframe):

    exchange, symbol, series    which series
    seq, last_ms                rows so far, close time of the last one
    values                      named numbers: ends of recurrences, running counts, the open position
    tail                        the last bars, as many as the widest window looks back

The next run numbers its rows from ``seq`` on, starts its scans and folds at
``values`` and puts ``tail`` in front of its windows, so it reads its own bars
only.  A snapshot grows with the number of keys, never with the bars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import DEFAULT_CHUNK_ROWS, chunk_expr, same_keys

KEYS = ["exchange", "symbol"]
TAIL_FIELDS = {
    "seq": "bigint", "open_time_ms": "bigint", "close_time_ms": "bigint", "interval": "string",
    "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double",
}
SNAPSHOT_SCHEMA = (
    "exchange string, symbol string, series string, seq bigint, last_ms bigint, values map<string,double>, "
    "tail array<struct<" + ",".join(f"{n}:{t}" for n, t in TAIL_FIELDS.items()) + ">>"
)


def series_of(snapshot: DataFrame | None, series: str | None) -> DataFrame | None:
    """The rows of one series (None: of every series)."""
    return snapshot if snapshot is None or series is None else snapshot.filter(F.col("series") == series)


def values_of(snapshot: DataFrame | None, keys: Sequence[str], names: dict[str, str]) -> DataFrame | None:
    """Keys and the named values as columns (value name -> type)."""
    if snapshot is None:
        return None
    return snapshot.select(*keys, *[F.col("values")[n].cast(t).alias(n) for n, t in names.items()])


def tail_rows(snapshot: DataFrame, like: DataFrame, base_col: str) -> DataFrame:
    """The kept bars as rows of ``like``'s columns; columns that the tail does not keep are null.  Their base is their own number."""
    kept = snapshot.select(*KEYS, F.explode("tail").alias("_t"))
    kept = kept.select(*KEYS, *[F.col(f"_t.{n}").alias(n) for n in TAIL_FIELDS])
    there = {*KEYS, *TAIL_FIELDS}
    column = lambda f: F.col("seq") if f.name == base_col else F.col(f.name) if f.name in there else F.lit(None)
    return kept.select(*[column(f).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _number_map(values: dict[str, Column]) -> Column:
    if not values:
        return F.expr("map()").cast("map<string,double>")
    return F.map_from_arrays(F.array(*[F.lit(n) for n in values]), F.array(*[v.cast("double") for v in values.values()]))


def taken(rows: DataFrame, series: Column, values: dict[str, Column], seq_col: str = "seq", tail: int = 0, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Snapshot rows of ``rows`` (a written table): per key and series the
    values on the last row, and the last ``tail`` bars.

    The tail is cut in two steps, so that no group is larger than a chunk: the
    chunks a key ends in, then the bars in them."""
    t = rows.withColumn("series", series)
    keys = [*KEYS, "series"]
    place = F.col(seq_col).cast("bigint")
    last = F.struct(place.alias("seq"), F.col("close_time_ms").alias("last_ms"), _number_map(values).alias("values"))
    ends = t.groupBy(*keys).agg(F.max_by(last, place).alias("_e")).select(*keys, "_e.seq", "_e.last_ms", "_e.values")
    if not tail:
        return ends.withColumn("tail", F.array().cast(f"array<struct<{','.join(f'{n}:{k}' for n, k in TAIL_FIELDS.items())}>>"))
    back = -(-tail // chunk_rows)
    chunks = ends.select(*keys, F.explode(F.sequence(F.floor((F.col("seq") - 1) / chunk_rows) - back, F.floor((F.col("seq") - 1) / chunk_rows))).alias("_chunk"),
                         (F.col("seq") - tail).alias("_after"))
    near = same_keys(t.withColumn("_chunk", chunk_expr(seq_col, chunk_rows)), chunks, [*keys, "_chunk"]).where(F.col(seq_col) > F.col("_after"))
    bar = F.struct(*[F.col(seq_col if n == "seq" else n).cast(k).alias(n) for n, k in TAIL_FIELDS.items()])
    tails = near.groupBy(*keys).agg(F.sort_array(F.collect_list(bar)).alias("tail"))
    return same_keys(ends, tails, keys)


def with_values(snapshot: DataFrame, more: DataFrame, values: Sequence[str]) -> DataFrame:
    """Add columns of ``more`` (one row per key) to the values of its keys' rows."""
    added = more.select(*KEYS, _number_map({n: F.col(n) for n in values}).alias("_more"))
    out = same_keys(snapshot, added, KEYS, "left")
    return out.withColumn("values", F.when(F.col("_more").isNotNull(), F.map_concat("values", "_more")).otherwise(F.col("values"))).drop("_more")


def followed_by(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """The snapshot after both: keys without new bars keep their rows."""
    names = ["exchange", "symbol", "series", "seq", "last_ms", "values", "tail"]
    if before is None:
        return after.select(*names)
    kept = same_keys(before, after.select(*KEYS, "series"), [*KEYS, "series"], "left_anti")
    return after.select(*names).unionByName(kept.select(*names))


def late_bars(bars: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Bars at or before the end of their key's series: a resumed run must not be given them."""
    ends = snapshot.groupBy(*KEYS).agg(F.max("last_ms").alias("_last"))
    return same_keys(bars, ends, KEYS).where(F.col("close_time_ms") <= F.col("_last")).drop("_last")

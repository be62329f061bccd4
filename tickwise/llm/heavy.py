"""Frequent keys by the Misra-Gries counter summary.

``approx_top_k`` keeps a bounded table of counters per task (Misra-Gries with
a purge of the median counter when the table is full).  The tables are merged
in ``SKETCHES`` groups of tasks side by side, and the groups' counts are summed
by key, so no task ever gets the tables of all tasks.  Whatever comes out is a
candidate list: callers verify every key exactly before they rely on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Keys returned at most: the proven bound of every table that callers broadcast.
MAX_FREQUENT = 1024
#: Counters kept per summary.  A key held by more than about rows / 2,000 rows is always found.
COUNTERS = 8192
#: Groups of tasks whose summaries are merged apart.
SKETCHES = 256
#: A key is hot when it has more than one in this many of all rows; so many can exist at most.
HOT_SHARE = 1024


def frequent_digests(rows: DataFrame, digest: str) -> DataFrame:
    """At most ``MAX_FREQUENT`` binary digests that occur more than once, one
    row each (column ``digest``'s name).  Null digests are not reported; an
    empty input gives an empty table."""
    some = rows.where(F.col(digest).isNotNull()).select(digest, (F.spark_partition_id() % SKETCHES).alias("_tasks"))
    tops = some.groupBy("_tasks").agg(F.expr(f"approx_top_k(hex(`{digest}`), {MAX_FREQUENT}, {COUNTERS})").alias("top"))
    found = tops.select(F.explode("top").alias("f")).groupBy("f.item").agg(F.sum("f.count").alias("n")).where("n > 1")
    return found.orderBy(F.desc("n"), "item").limit(MAX_FREQUENT).select(F.unhex("item").alias(digest))


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` joined with a table of one row per key; the keys in ``hot`` (a
    proven few, ``HOT_SHARE``) map-side, the others by an ordinary shuffle.
    Both tables are read twice."""
    few = F.broadcast(table.join(F.broadcast(hot), on, "left_semi"))
    return rows.join(few, on).unionByName(rows.join(F.broadcast(hot), on, "left_anti").join(table, on))


def with_largest(rows: DataFrame, digest: str, by: list[str]) -> DataFrame:
    """Add ``w``, the largest struct of ``by`` among the rows of a digest, and
    ``group_size`` to every row.

    ``rows`` is read several times, so it should be a written table.  Frequent
    digests are settled by an exact aggregation of partial results and a
    map-side join of at most ``MAX_FREQUENT`` rows; the others by an ordinary
    shuffle.  Digests must not be null."""
    largest = [F.max(F.struct(*by)).alias("w"), F.count("*").alias("group_size")]
    frequent = frequent_digests(rows, digest)
    winners = materialize(rows.join(F.broadcast(frequent), digest).groupBy(digest).agg(*largest))
    hot = rows.join(F.broadcast(winners), digest)
    rest = rows.join(F.broadcast(winners.select(digest)), digest, "left_anti")
    return hot.unionByName(rest.join(rest.groupBy(digest).agg(*largest), digest))

"""Shards of near-equal bytes by k-d tree partitioning.

Documents are points of a metadata space: place in the id range, length,
language and source, each scaled to 0..1 over the whole corpus.  A node with k
shards is cut along its widest dimension at the weighted median -- the place
where the first k // 2 shards' share of its bytes lies -- until every leaf is
one shard.  Documents near each other in the metadata land in one shard.

* Equal texts are one point, so copies stay together, unless they weigh more
  than ``WHOLE_SHARE`` of a shard or are a large share of all rows: such a group
  is dealt into parts that follow each other in every order, and only a cut
  that falls inside it separates them.
* The median is exact and distributed: points are sorted by range (node,
  coordinate, digest), bytes are summed within each range, and ranges are joined
  by running totals over one row per (node, range).  A level of the tree is one
  sort of narrow rows whatever the number of nodes.
* The law is bytes: a cut misses the median by half a point at most, which is
  half of ``WHOLE_SHARE`` of a shard or half of one document.

Texts are read once, for their size and digest, and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: A group of copies heavier than this part of a shard's bytes is dealt into parts.
WHOLE_SHARE = 1 / 16
#: Parts that a dealt group has per shard's worth of bytes, and rows of a part: one in this many of all rows.
PARTS_PER_SHARD, ROW_SHARE = 64, 1024
#: Groups dealt into parts are broadcast while at most so many can exist.
BROADCAST_GROUPS = 1 << 14
#: Rows numbered together, about.
GROUP_ROWS = 4096


def text_place(value: Column) -> Column:
    """A string's first seven bytes as a number that keeps their order."""
    head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("double")


def document_coordinates(docs: DataFrame) -> dict[str, Column]:
    """The metadata dimensions of ``documents`` (those of its columns that are there)."""
    known = {
        "doc_id": lambda: F.col("doc_id").cast("double"),
        "n_chars": lambda: F.log2(F.greatest(F.col("n_chars"), F.lit(0)).cast("double") + 1),
        "lang": lambda: text_place(F.col("lang")),
        "source": lambda: text_place(F.col("source")),
    }
    return {name: made() for name, made in known.items() if name in docs.columns}


def _scaled(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Coordinates from 0 to 1 over all rows; null ones, and a dimension without width, are 0."""
    ends = rows.agg(*[F.min(c).alias(f"min_{c}") for c in names], *[F.max(c).alias(f"max_{c}") for c in names]).first()
    out = {}
    for c in names:
        low, high = ends[f"min_{c}"], ends[f"max_{c}"]
        wide = low is not None and high > low
        out[c] = F.coalesce((F.col(c) - low) / F.lit(high - low), F.lit(0.0)) if wide else F.lit(0.0)
    return rows.withColumns(out)


def _running(points: DataFrame, by: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """Add ``before``: the weight of the points of the same ``by`` that come
    earlier in ``order``.  Sorted by range; sums within ranges plus a running
    total over one row per (by, range)."""
    ranged = points.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged)
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*by, "_range").agg(F.sum(weight).alias("_sum"))
    sums = sums.select(*by, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    local = ranged.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return local.join(F.broadcast(sums), [*by, "_range"]).withColumn("before", F.col("_local") + F.col("_base")).drop("_local", "_base", "_range")


def split_points(points: DataFrame, dims: Sequence[str], shards: int) -> DataFrame:
    """Add ``shard`` to points (digest, part, weight and the coordinates
    ``dims``): the leaves of the k-d tree from left to right."""
    dims = list(dims)
    nodes = materialize(points.withColumn("shard", F.lit(0)).withColumn("_k", F.lit(shards)))
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        extent = [(F.max(d) - F.min(d)).alias(f"_w_{d}") for d in dims]
        wide = nodes.where("_k > 1").groupBy("shard").agg(F.sum("weight").alias("_bytes"), *extent)
        widest = F.greatest(*[F.col(f"_w_{d}") for d in dims], F.lit(0.0), F.lit(0.0))
        axis = F.coalesce(*[F.when(F.col(f"_w_{d}") == widest, F.lit(i)) for i, d in enumerate(dims)], F.lit(0))
        # One row per node, at most as many as there are shards.
        wide = F.broadcast(wide.select("shard", "_bytes", axis.alias("_axis")))
        along = F.coalesce(*[F.when(F.col("_axis") == i, F.col(d)) for i, d in enumerate(dims)], F.lit(0.0))
        cut = _running(nodes.where("_k > 1").join(wide, "shard").withColumn("_at", along), ["shard"], ["_at", "digest", "part"], "weight")
        left = F.floor(F.col("_k") / 2).cast("int")
        is_left = (F.col("before") + F.col("weight") / 2) * F.col("_k") < F.col("_bytes") * left
        cut = cut.withColumn("_shard", F.when(is_left, F.col("shard")).otherwise(F.col("shard") + left))
        cut = cut.withColumn("_k", F.when(is_left, left).otherwise(F.col("_k") - left)).withColumn("shard", F.col("_shard"))
        nodes = materialize(cut.select(*nodes.columns).unionByName(nodes.where("_k <= 1")))
    return nodes.drop("_k")


def numbered(rows: DataFrame, by: str, uid: str, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within ``by``, without gaps.  Rows are
    numbered in salted groups of about ``GROUP_ROWS``; ``uid`` is unique."""
    total = rows.count()
    salt = F.pmod(F.xxhash64(uid), F.lit(max(1, -(-total // GROUP_ROWS))))
    salted = rows.withColumn("_salt", salt)
    sizes = salted.groupBy(by, "_salt").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(by, "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy(by, "_salt").orderBy(uid))
    out = salted.withColumn("_own", own).join(base, [by, "_salt"])
    return out.withColumn(name, (F.col("_base") + F.col("_own") - 1).cast("bigint")).drop("_salt", "_own", "_base")


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """Leaves that the tree needs for leaves of about the target."""
    return max(1, round(total_bytes / target_bytes))


def shard_documents(
    docs: DataFrame, shards: int | None = 8, target_bytes: int | None = None, coordinates: dict[str, Column] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    ``shards``, or as many as bring leaves to ``target_bytes``.  Size is the
    text's UTF-8 bytes plus 1; a null text has no bytes.  A dimension without
    values is passed over, null coordinates count as the smallest, ties are
    ordered by the text's digest.  Repeated rows are rows of their own, null
    ids are kept.  With fewer points than shards some shards stay empty; an
    empty table gives an empty table.  Columns besides the two named are read
    only as coordinates (see ``document_coordinates``).  Reruns over the same
    files agree."""
    made = document_coordinates(docs) if coordinates is None else coordinates
    dims = [f"_x{i}" for i in range(len(made))]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"), *[x.cast("double").alias(d) for x, d in zip(made.values(), dims)],
    )
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()))
    whole = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    total, count = whole["bytes"] or 0, whole["rows"]
    if shards is None:
        shards = shards_for(total, target_bytes)
    rows = _scaled(rows, dims) if dims and count else rows
    at = [F.min(d).alias(d) for d in dims]

    # Groups of copies that are dealt into parts: few, by their share of all bytes or rows.
    heavy_bytes, heavy_rows = total * WHOLE_SHARE / shards, count / ROW_SHARE
    groups = rows.groupBy("digest").agg(F.sum("size").alias("weight"), F.count("*").alias("n"), *at)
    groups = groups.where((F.col("n") > 1) & ((F.col("weight") > heavy_bytes) | (F.col("n") > heavy_rows)))
    parts = F.greatest(F.ceil(F.col("weight") * shards * PARTS_PER_SHARD / F.lit(max(1, total))), F.ceil(F.col("n") / F.lit(max(1.0, heavy_rows))))
    groups = groups.select("digest", parts.alias("_parts"), *[F.col(d).alias(f"g{d}") for d in dims])
    few = shards / WHOLE_SHARE + ROW_SHARE <= BROADCAST_GROUPS
    rows = rows.join(F.broadcast(groups) if few else groups, "digest", "left")
    part = F.coalesce(F.pmod(F.xxhash64("uid"), F.col("_parts")), F.lit(0))
    rows = rows.withColumn("part", part).withColumns({d: F.coalesce(f"g{d}", d) for d in dims}).drop("_parts", *[f"g{d}" for d in dims])
    rows = materialize(rows)

    points = rows.groupBy("digest", "part").agg(F.sum("size").alias("weight"), *at)
    placed = split_points(points, dims, shards).select("digest", "part", "shard")
    found = materialize(rows.select("doc_id", "size", "text_crc32", "uid", "digest", "part").join(placed, ["digest", "part"]))
    return numbered(found, "shard", "uid", "slot").select("doc_id", "size", "text_crc32", "shard", "slot")

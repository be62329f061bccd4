"""SimHash near-duplicates by multi-index hashing.

* **Fingerprints**: one Arrow pass over the whole texts (as UTF-8 bytes), one
  document at a time and in bounded slices of its shingles.
* **Multi-index hashing**: a 64-bit fingerprint has two 32-bit segments.  Two
  fingerprints with at most 3 differing bits differ by at most one bit in one
  of the segments (pigeonhole).  Every distinct fingerprint is stored in a
  table under both segment values, and looks up the Hamming ball of radius
  one around each of its segments.  A pair one bit apart is found from the end
  that has 0 there, so only zero bits are flipped: about 17 look-ups a segment.
  Matches are verified on the complete 64-bit distance.
* **Copies** share a fingerprint, so links are searched between distinct
  fingerprints; a group of copies, however large, is one table entry.
* **Crowded segment values** (more than ``crowd`` distinct fingerprints) would
  pair up quadratically.  Their members are linked exactly without pairs, over
  points of the Hamming cube: see ``_crowded_links``.
* Components of the links carry the smallest document id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .components import components
from .heavy import HOT_SHARE, join_hot

#: Segment values with more distinct fingerprints than this are linked over cube points.
CROWD = 1024
_SLICE = 1 << 15
_ZERO = 0


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text in UTF-8: ASCII-lowered words between ASCII
    white space, ``shingle``-word shingles joined by a space (a shorter text:
    its whole word sequence), XXH64 per shingle; a bit is 1 if it is set in
    over half of the hashes.  No word: 0."""
    words = text.lower().split()
    if not words:
        return _ZERO
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    lo, hi = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(lo), _SLICE):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(lo[at : at + _SLICE], hi[at : at + _SLICE])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(lo), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed long; null text: 0."""
    ship_package(SparkSession.active())

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(np.array([fingerprint(t.as_py() or b"", shingle) for t in column], np.uint64).view(np.int64))

    return run(text.cast("binary"))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp), one row per input row."""
    return docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segment(fp: Column, which: int) -> Column:
    """The low (0) or high (1) 32 bits, as a long."""
    return F.shiftrightunsigned(fp, 32 * which).bitwiseAND(F.lit(0xFFFFFFFF))


def _table(prints: DataFrame) -> DataFrame:
    """(seg, key, fp): every fingerprint under both of its segment values."""
    entries = F.array(*[F.struct(F.lit(s).alias("seg"), _segment(F.col("fp"), s).alias("key")) for s in (0, 1)])
    return prints.select("fp", F.explode(entries).alias("e")).select("e.seg", "e.key", "fp")


def _probes(table: DataFrame) -> DataFrame:
    """(seg, key, probe): the segment values one zero bit away from a fingerprint's own, and its own."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    ball = table.select("seg", "key", F.col("fp").alias("probe"), F.explode(flips).alias("m"))
    return ball.where(F.col("key").bitwiseAND(F.col("m")) == 0).select(
        "seg", F.col("key").bitwiseOR(F.col("m")).alias("key"), "probe", (F.col("m") == 0).alias("own")
    )


def _crowded_links(members: DataFrame, max_bits: int) -> DataFrame:
    """Edges that connect all members within ``max_bits`` of each other, without pairs.

    Let c be a point of the cube, and half the bits rounded down and up (1 and
    2 of 3).  A member within the lower half of c links to every member within
    the upper half, and any close pair has such a point between its ends.  So
    each member emits the points within the upper half (2,081 rows for 3 bits,
    aggregated on the map side per point), and a point that has a member within
    the lower half links all its members to the smallest such member.  Members
    of a point are joined back by point, never with each other."""
    least, most = max_bits // 2, -(-max_bits // 2)

    def cube(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = [1 << i for i in range(64)]
        balls = [[0], one, [x | y for i, x in enumerate(one) for y in one[:i]]][: most + 1]
        masks = np.array([m for ball in balls for m in ball], np.uint64)
        near = np.arange(len(masks)) < sum(map(len, balls[: least + 1]))
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(prints), 64):
                own = prints[at : at + 64]
                points = (own[:, None] ^ masks[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points), pa.array(np.repeat(own, len(masks)).view(np.int64)), pa.array(np.tile(near, len(own)))],
                    ["point", "fp", "near"],
                )

    points = members.select("fp").mapInArrow(cube, "point bigint, fp bigint, near boolean")
    hubs = points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.count("*").alias("n"))
    hubs = hubs.where("hub IS NOT NULL AND n > 1").select("point", "hub")
    return points.join(hubs, "point").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def links(prints: DataFrame, max_bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct
    fingerprints (column ``fp``) at most ``max_bits`` (3 or fewer) bits apart.
    Outside crowded segment values these are exactly the pairs."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one cover at most 3 bits")
    table = _table(prints)
    probes = _probes(table)
    crowded = materialize(table.groupBy("seg", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("seg", "key"))
    split = not crowded.isEmpty()
    if split:
        members = table.join(crowded, ["seg", "key"]).select("fp").union(
            probes.join(crowded, ["seg", "key"]).select(F.col("probe").alias("fp"))
        ).distinct()
        table, probes = (x.join(crowded, ["seg", "key"], "left_anti") for x in (table, probes))
    # A pair with equal segment values meets twice (each finds the other): the smaller one reports it.
    # Never broadcast: Spark sizes the probes by the table they are expanded from.
    found = probes.hint("merge").join(table, ["seg", "key"]).where(
        (F.col("probe") != F.col("fp")) & (~F.col("own") | (F.col("probe") < F.col("fp")))
        & (distance(F.col("probe"), F.col("fp")) <= max_bits)
    )
    out = found.select(F.least("probe", "fp").alias("a"), F.greatest("probe", "fp").alias("b"))
    if split:
        out = out.unionByName(_crowded_links(members, max_bits))
    return out


def _labels(prints: DataFrame, max_bits: int, crowd: int) -> DataFrame:
    """(fp, n, component_id, keeper) per distinct fingerprint of (id, fp) rows,
    written once: how many rows have it, the smallest id of its component, and
    the fingerprint that has that id."""
    groups = materialize(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    roots = components(links(groups.select("fp"), max_bits, crowd), "a", "b")
    joined = groups.join(roots, groups.fp == roots.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    joined = materialize(joined)
    first = F.min(F.when(F.col("least").isNotNull(), F.struct("least", "fp")))
    least = joined.groupBy("root").agg(first.alias("first"), F.min("fp").alias("any"), F.count("*").alias("size"))
    least = materialize(least.select("root", "size", F.col("first.least").alias("component_id"), F.coalesce("first.fp", "any").alias("keeper")))
    large = least.where(F.col("size") > F.lit(joined.count() // HOT_SHARE)).select("root")
    return materialize(join_hot(joined, least, ["root"], large).select("fp", "n", "component_id", "keeper"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, crowd: int = CROWD
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 lower-case hex digits),
    component_id (the smallest id whose document is reachable over links).

    Null, empty and wordless texts have fingerprint zero and are linked like
    any other.  Repeated rows give repeated result rows.  Null ids are ignored
    in component_id (null if a component has no other).  An empty table gives
    an empty table; other columns are not read."""
    rows = materialize(with_fingerprints(docs, id_col, text_col, shingle))
    labels = _labels(rows, max_bits, crowd)
    hot = labels.where(F.col("n") > F.lit(rows.count() // HOT_SHARE)).select("fp")
    return join_hot(rows, labels.select("fp", "component_id"), ["fp"], hot).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, crowd: int = CROWD
) -> DataFrame:
    """One row of every component, all its columns unchanged: the one with the
    smallest id (a null id is larger than any).  If that row is repeated, or
    its id and fingerprint occur in several rows, one of them stays."""
    names = docs.columns
    columns = [F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), fingerprint_column(F.col(text_col), shingle).alias("fp")]
    prints = materialize(docs.select(*columns))
    kept = _labels(prints.select("id", "fp"), max_bits, crowd).where("fp = keeper").select("fp", "component_id")
    rows = prints.groupBy("id", "fp", "hash").agg(F.count("*").alias("n")).groupBy("id", "fp").agg(F.min(F.struct("hash", "n")).alias("r"))
    kept = rows.alias("r").join(kept.alias("k"), (F.col("r.fp") == F.col("k.fp")) & F.col("id").eqNullSafe(F.col("component_id")))
    kept = materialize(kept.select(F.col("id").alias("_nd_id"), F.col("r.r.hash").alias("_nd_hash"), F.col("r.r.n").alias("_nd_n")))
    # The texts meet the kept rows by id and text hash: fingerprints are not computed again.
    met = docs.join(kept, F.col(id_col).eqNullSafe(F.col("_nd_id")) & (F.xxhash64(F.col(text_col)) == F.col("_nd_hash")))
    out = met.where("_nd_n = 1").select(*names)
    if kept.where("_nd_n > 1").isEmpty():
        return out
    one = met.where("_nd_n > 1").groupBy("_nd_id", "_nd_hash").agg(F.any_value(F.struct(*names)).alias("_nd_row"))
    return out.unionByName(one.select("_nd_row.*"))

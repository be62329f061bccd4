"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key, -ln(u) / w, with u from a hash of the
document and w its quality weight.  Taking documents of a source in ascending
key order until a word budget is a weighted sample without replacement.  A
source whose target exceeds its size is first taken whole as often as it fits
(complete epochs); the sampling fills the fraction that is left.

The order within a source is never sorted as a whole: a budget ends at one
key, and that key is found by radix selection -- sums per (source, bucket of
the key's distribution function) narrow it to one bucket in 1,024, twice, and
only the rows of the last bucket are sorted and prefix-summed.  Afterwards a
row's share is a map-side test against its source's cut, so a source that
holds a third of all rows is only ever aggregated with partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import word_hash

#: Source weights by code point order of the sources, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words to mix over the words there are, and the most often a source is repeated.
SHARE, MOST = 1.5, 2.0
SEED = 11
_RADIX = 1024

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def measure(text: Column) -> Column:
    """Struct of size (words between ASCII white space) and weight (quality: a
    half, and the share of letters among the bytes that are not white space).
    Null: size 0, weight a half."""

    @F.arrow_udf("size bigint, weight double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            size, weight = np.zeros(len(column), np.int64), np.zeros(len(column))
            for at, rows, data, ends in word_hash.steps(column):
                solid = ~_SPACE[data]
                begins = solid.copy()
                begins[1:] &= ~solid[:-1]
                firsts = ends[:-1][ends[:-1] < len(data)]
                begins[firsts] = solid[firsts]
                counts = [np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))] for x in (begins, solid, _LETTER[data])]
                words, bytes_, letters = (np.diff(c) for c in counts)
                size[at : at + rows] = words
                weight[at : at + rows] = 0.5 + letters / np.maximum(bytes_, 1)
            yield pa.StructArray.from_arrays([pa.array(size), pa.array(weight)], ["size", "weight"])

    return run(text.cast("binary"))


def exponential_key(weight: Column, *what: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of ``what``: the same rows draw the same keys in every run."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *what), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``target`` to (source, source_size) rows, one per source.

    ``share`` of all words is dealt out by weight; a target stops at ``most``
    times its source's size and the excess goes to the others by weight, until
    none is above.  In ascending order of cap over weight the capped sources
    come first, so the common level is found by running sums (windows over one
    row per source, the only unpartitioned ones)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("w"))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    used, used_w = (F.coalesce(F.sum(c).over(by_ratio), F.lit(0.0)) for c in ("cap", "w"))
    rows = rows.withColumn("level", (total - used) / (F.sum("w").over(whole) - used_w))
    rows = rows.withColumn("capped", F.col("ratio") < F.col("level"))
    # The level of the first source that is not capped holds for all that are not.
    level = F.min(F.when(~F.col("capped"), F.struct("ratio", "level"))).over(whole)["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("w") * level))
    return rows.select("source", "source_size", target.alias("target"))


def _narrowed(rows: DataFrame, cuts: DataFrame, parts: int) -> DataFrame:
    """One radix step.  rows: (source, spot in [0, 1), key, size) still in
    question; cuts: (source, budget still to fill).  Returns (source, bucket,
    budget): the bucket that the budget ends in and what is left for it."""
    sums = rows.withColumn("bucket", F.floor(F.col("spot") * parts)).groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    run = Window.partitionBy("source").orderBy("bucket")  # at most _RADIX rows a source
    sums = sums.withColumn("upto", F.sum("n").over(run))
    met = sums.alias("s").join(cuts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")))
    met = met.where((F.col("upto") - F.col("n") <= F.col("budget")) & (F.col("upto") > F.col("budget")))
    return met.groupBy(F.col("s.source").alias("source")).agg(
        F.min(F.struct("bucket", (F.col("budget") - F.col("upto") + F.col("n")).alias("budget"))).alias("m")
    ).select("source", "m.bucket", "m.budget")


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, cut): a row of the source is taken
    ``epochs`` times, and once more if its key is at most ``cut``.

    rows: (source, size, key).  The cut is the key at which the words taken
    come nearest to the target.  Equal keys (repeated rows) go together."""
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = materialize(goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    open_ = goals.select("source", "budget")
    rows = rows.where(F.col("size") > 0).select("source", "key", "size", (F.lit(1.0) - F.exp(-F.col("key"))).alias("spot"))
    for parts in (_RADIX, _RADIX * _RADIX):
        found = materialize(_narrowed(rows, open_, parts))
        near = found.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"))
        rows = rows.join(near, F.col("source").eqNullSafe(F.col("_s")) & (F.floor(F.col("spot") * parts) == F.col("_b"))).select(rows.columns)
        open_ = found.select("source", "budget")
    keys = rows.groupBy("source", "key").agg(F.sum("size").alias("n"))
    keys = keys.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("key")))
    met = keys.alias("k").join(open_.alias("o"), F.col("k.source").eqNullSafe(F.col("o.source")))
    # Nearest end to the budget; taking none of the last bucket ends just below its first key.
    ends = met.groupBy(F.col("k.source").alias("_s")).agg(
        F.min(F.struct(F.abs(F.col("upto") - F.col("budget")).alias("off"), F.col("key"))).alias("best"),
        F.min("key").alias("first"), F.max("budget").alias("none"),
    )
    cut = F.when(F.col("best.off") < F.col("none"), F.col("best.key")).otherwise(F.col("first") * (1 - 1e-15) - 1e-300)
    ends = ends.select("_s", cut.alias("cut"))
    out = goals.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.select("source", "source_size", "target", "epochs", F.coalesce("cut", F.lit(-1.0)).alias("cut"))


def _with_key(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``docs`` with _mix_size and _mix_key."""
    ship_package(docs.sparkSession)
    key = exponential_key(F.col("_mix_m.weight"), F.col(id_col), F.col(source_col), F.xxhash64(text_col))
    return docs.withColumn("_mix_m", measure(F.col(text_col))).select(
        *docs.columns, F.col("_mix_m.size").alias("_mix_size"), key.alias("_mix_key")
    )


def _with_copies(keyed: DataFrame, source_col: str) -> DataFrame:
    """Rows of ``_with_key`` with their source's size and target and the
    number of _mix_copies taken; the plan is made from one narrow table."""
    rows = materialize(keyed.select(F.col(source_col).alias("source"), F.col("_mix_size").alias("size"), F.col("_mix_key").alias("key")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = materialize(cuts(rows, targets(sizes)))
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    copies = F.col("_mix_epochs") + (F.col("_mix_key") <= F.col("_mix_cut")).cast("int")
    return keyed.join(plan, F.col(source_col).eqNullSafe(F.col("_mix_source"))).withColumn("_mix_copies", copies.cast("int"))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words, repeats counted).

    Null texts have size 0 and are never counted; a null source is a source of
    its own, last in order.  Rows with equal id, source and text share one draw
    and are taken together.  An empty table gives an empty table; other columns
    are not read."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    keyed = materialize(_with_key(narrow, "doc_id", "source", "text").drop("text"))
    taken = (F.col("_mix_size") * F.col("_mix_copies")).alias("taken")
    names = [F.col(f"_mix_{c}").alias(c) for c in ("size", "source_size", "target")]
    return _with_copies(keyed, "source").select("doc_id", *names, taken)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it (0, 1 or 2
    times), all columns unchanged.  Documents without words add nothing to a
    budget; they come with each complete epoch of their source and follow the
    cut like any other."""
    taken = _with_copies(_with_key(docs, id_col, source_col, text_col), source_col)
    return taken.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)

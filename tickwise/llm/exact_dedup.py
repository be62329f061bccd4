"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. One scan of the texts gives narrow rows (id, SHA-256 of the normalised
   text), written once; nothing later touches a text again.
2. Misra-Gries finds the frequent digests; an exact aggregation (partial sums
   per task, so a few rows per digest are shuffled) verifies their sizes and
   winners.  At most ``heavy.MAX_FREQUENT`` rows: a proven broadcast bound.
3. Rows of frequent digests get their winner by a map-side join: a group that
   holds a third of all rows never meets in one task.
4. The remaining digests go through an ordinary shuffle aggregation and join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .heavy import with_largest

# Fixed values of the contract: only these letters are folded.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_ID, _DIGEST, _ROW, _FLAG = "_xd_id", "_xd_digest", "_xd_row", "_xd_flag"


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the text in UTF-8 with A-Z lower-cased; null counts as the empty text."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.unhex(F.sha2(folded.cast("binary"), 256))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, digest, keep_id, group_size, kept), internal names.

    Of equal texts the row with the largest id stays; a null id is smaller
    than any other.  Of repeated rows (same id, same text) exactly one is kept.
    Null and empty texts are one group.  An empty table gives an empty table.
    Columns other than the two named ones are not read."""
    rows = materialize(
        docs.select(F.col(id_col).alias(_ID), text_digest(F.col(text_col)).alias(_DIGEST)).withColumn(
            _ROW, F.monotonically_increasing_id()
        )
    )
    return with_largest(rows, _DIGEST, [_ID, _ROW]).select(
        _ID, _DIGEST, F.col("w")[_ID].alias("keep_id"), "group_size", (F.col("w")[_ROW] == F.col(_ROW)).alias("kept")
    )


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decide`` with its public columns: doc_id, keep_id, group_size, kept, text_sha256."""
    return decide(docs, id_col, text_col).select(
        F.col(_ID).alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex(_DIGEST)).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged.

    Dropped rows are found on the narrow rows and removed by one join on (id,
    digest).  Where a kept row also has identical repeats (same id and text),
    one of the repeats stays, with the columns of any one of them."""
    keys = materialize(
        decide(docs, id_col, text_col)
        .groupBy(_ID, _DIGEST)
        .agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
        .where(~F.col("kept") | (F.col("n") > 1))
        .select(F.col(_ID).alias("_xd_id2"), F.col(_DIGEST).alias("_xd_digest2"), F.when(F.col("kept"), "repeat").otherwise("drop").alias(_FLAG))
    )
    names = docs.columns
    marked = docs.withColumn(_DIGEST, text_digest(F.col(text_col))).join(
        keys, F.col(id_col).eqNullSafe(F.col("_xd_id2")) & (F.col(_DIGEST) == F.col("_xd_digest2")), "left"
    )
    out = marked.where(F.col(_FLAG).isNull()).select(*names)
    if keys.where(F.col(_FLAG) == "repeat").isEmpty():
        return out
    one = (
        marked.where(F.col(_FLAG) == "repeat")
        .groupBy(_DIGEST)
        .agg(F.any_value(F.struct(*names)).alias("r"))
        .select("r.*")
    )
    return out.unionByName(one)


ORACLE_SQL = f"""
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""

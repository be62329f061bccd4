"""Folds and training rows of the label table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ftrl import Settings


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learned: crc32 of the id as text is
    0 modulo 5.  A null id is not held out (and has no label to learn)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> DataFrame:
    """(id, text, label) of about ``settings.sample_rows`` labelled documents
    outside the held-out fold, one row per id.

    The sample is chosen on the label table alone, by a hash of the id (reruns
    agree), so it is bounded before it meets a text and the texts are found by
    a map-side join.  Rows with a null id, labels other than 0 and 1 and null
    texts are not trained on; repeated label rows count once (the largest
    label), repeated documents once."""
    usable = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("_label_id")).agg(F.max(label).alias("label"))
    )
    rows = usable.count()
    # 53 bits of the hash as a double: exact for any number of rows.
    chance = F.pmod(F.xxhash64("_label_id", F.lit(settings.seed)), F.lit(1 << 53)).cast("double") / float(1 << 53)
    chosen = usable if rows <= settings.sample_rows else usable.where(chance < settings.sample_rows / rows)
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(F.col("text").isNotNull())
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("_label_id"))
    return found.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))

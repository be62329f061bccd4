"""Quality classifier: hashed word n-gram logistic regression, trained by
following the regularised leader, scored as a sparse dot product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .labels import held_out, training_sample

SETTINGS = ftrl.Settings(gaps=(1,), alpha=3.0, l1=8.0, l2=0.0, epochs=5, sample_rows=16_000)
THRESHOLD = 0.3


def train(docs: DataFrame, labels: DataFrame, settings: ftrl.Settings = SETTINGS) -> ftrl.Model:
    return ftrl.fit(training_sample(docs, labels, "quality", settings), settings)


def score_quality(docs: DataFrame, model: ftrl.Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.  Null and
    empty texts get the score of a text without words.  Null ids are scored
    and not held out.  Columns other than doc_id and text are not read."""
    scored = docs.select("doc_id", ftrl.score(model, F.col("text")).alias("score"))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def keep_good(docs: DataFrame, model: ftrl.Model) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all their columns unchanged."""
    return docs.where(ftrl.score(model, F.col("text")) >= THRESHOLD)

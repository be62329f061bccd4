"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

L1 leaves few weights, so the model is a compact table that is broadcast; the
score of a text is the sigmoid of a sparse dot product over its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ftrl
from .labels import held_out, training_sample

SETTINGS = ftrl.Settings(gaps=(1, 2), alpha=3.0, l1=8.0, l2=0.0, epochs=5, sample_rows=24_000)
THRESHOLD = 0.5


def train(docs: DataFrame, labels: DataFrame, settings: ftrl.Settings = SETTINGS) -> ftrl.Model:
    return ftrl.fit(training_sample(docs, labels, "toxic", settings), settings)


def score_toxicity(docs: DataFrame, model: ftrl.Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.  Null and
    empty texts get the score of a text without words.  Null ids are scored
    and not held out.  Columns other than doc_id and text are not read."""
    scored = docs.select("doc_id", ftrl.score(model, F.col("text")).alias("score"))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)

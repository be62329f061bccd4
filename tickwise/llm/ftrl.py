"""Logistic regression over hashed features by FTRL-proximal, per coordinate.

Training reads a bounded, documented sample of labelled rows in one task (its
size is a parameter, whatever the corpus size); scoring is a map over all
texts with the sparse weights, which L1 keeps few and which travel with the
task's closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import word_hash


@dataclass(frozen=True)
class Settings:
    """Features and training of a classifier.

    ``sample_rows``: labelled rows trained on, about.  ``example_features``:
    of a training text with more distinct n-grams, so many are learned from,
    chosen by a hash over the whole text (the sample's memory is at most 4
    bytes times the product of both).  Scoring has no such bound."""

    bits: int = 20
    gaps: tuple[int, ...] = (1,)
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    sample_rows: int = 12_000
    example_features: int = 1 << 14
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature number (ascending), and the bias."""

    settings: Settings
    index: np.ndarray
    weight: np.ndarray
    bias: float


def features(data: np.ndarray, ends: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(feature number, text number) of every n-gram, repeats included."""
    hashes, text = word_hash.grams(*word_hash.word_hashes(data, ends), settings.gaps)
    return (hashes & np.uint64((1 << settings.bits) - 1)).astype(np.int64), text


def _unique_by_text(number: np.ndarray, text: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(text << bits | number)
    return both & ((1 << bits) - 1), both >> bits


def _some_by_text(number: np.ndarray, text: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's features at most ``most``, those of the smallest hash."""
    order = np.lexsort((word_hash.mix(number.astype(np.uint64)), text))
    number, text = number[order], text[order]
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    rank = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
    number, text = number[rank < most], text[rank < most]
    order = np.lexsort((number, text))
    return number[order], text[order]


def fit_examples(examples: list[np.ndarray], labels: np.ndarray, s: Settings) -> Model:
    """Follow the regularised leader over the examples (sets of feature
    numbers), in a seeded order per epoch.  z and n are kept per coordinate:
    the rate of a coordinate falls with the gradients it has seen, and it
    leaves zero only when |z| exceeds L1.  The bias has no L1."""
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    l1 = np.full(size + 1, s.l1)
    l1[size] = 0.0
    rng = np.random.default_rng(s.seed)

    def weights(i):
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1[i], 0.0)
        return -shrunk / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for row in rng.permutation(len(examples)):
            i = np.append(examples[row], size)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[row]
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / s.alpha * w
            n[i] = grown
    w = weights(np.arange(size + 1))
    index = np.flatnonzero(w[:size])
    return Model(s, index, w[index], float(w[size]))


def fit(sample: DataFrame, settings: Settings) -> Model:
    """Train on a bounded sample of (id, text, label 0/1) rows (see
    ``labels.training_sample``).  With no row the model is the constant 1/2."""
    ship_package(sample.sparkSession)
    sample = sample.select("id", F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, count, data, ends in word_hash.steps(batch.column(1)):
                number, text = _unique_by_text(*features(data, ends, settings), settings.bits)
                if len(text) and np.bincount(text).max() > settings.example_features:
                    number, text = _some_by_text(number, text, settings.example_features)
                cuts = np.searchsorted(text, np.arange(count + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, count), batch.column(2).slice(at, count), lists], ["id", "label", "features"]
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, labels = [], []
        for batch in batches:
            examples += [x.values.to_numpy() for x in batch.column(2)]
            labels += batch.column(1).to_pylist()
        model = fit_examples(examples, np.array(labels, float), settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(model.index, -1)), pa.array(np.append(model.weight, model.bias))], ["i", "w"]
        )

    kind = sample.schema["id"].dataType.simpleString()
    examples = sample.mapInArrow(hashed, f"id {kind}, label int, features array<int>")
    # A bounded sample: one task, in the order of the ids' hash whatever the partitions were.
    one = examples.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    found = one.mapInArrow(train, "i bigint, w double").collect()  # at most 2 ** bits + 1 weights
    pairs = sorted((r["i"], r["w"]) for r in found)
    if not pairs:
        return Model(settings, np.zeros(0, np.int64), np.zeros(0), 0.0)
    index, weight = np.array([p[0] for p in pairs[1:]], np.int64), np.array([p[1] for p in pairs[1:]])
    return Model(settings, index, weight, pairs[0][1])


def score(model: Model, text: Column) -> Column:
    """The sigmoid of the bias and the weights of the distinct n-grams of the
    whole text, between 0 and 1.  A null text scores as an empty one."""
    spark = SparkSession.active()
    ship_package(spark)
    s, bias = model.settings, model.bias
    shared = spark.sparkContext.broadcast((model.index, model.weight))

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, weight = shared.value
        dense = np.zeros(1 << s.bits, np.float32)
        dense[index] = weight
        for column in batches:
            total = np.full(len(column), bias)
            for at, count, data, ends in word_hash.steps(column):
                number, text = features(data, ends, s)
                live = dense[number] != 0
                number, text = _unique_by_text(number[live], text[live], s.bits)
                total[at : at + count] += np.bincount(text, dense[number], count)
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))

    return run(text.cast("binary"))

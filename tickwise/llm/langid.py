"""Language identification by multilingual mixture inference.

Every document is a mixture of languages: its n-grams (byte trigrams of
letters and word boundaries, and whole words, hashed) are drawn from language
l with probability p(n-gram | l) and share pi_l.  Expectation-maximisation
estimates the shares from the whole text; the set of languages is chosen by
penalised likelihood among the sets of the k largest shares, and the language
with the largest share in that set is the prediction.

The n-gram likelihoods are learned from a bounded sample of labelled rows per
language; its size is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import word_hash

UNDETERMINED = "und"
#: Languages up to which the table of their sizes is broadcast.
BROADCAST_LANGUAGES = 4096
_HALF = 1 << 16
_FEATURES = 2 * _HALF

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_SYMBOL = np.where(_LETTER, np.arange(256), 32).astype(np.uint32)
_SYMBOL[65:91] += 32
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[128:] = False


@dataclass(frozen=True)
class Settings:
    """``per_language``: labelled rows learned from per language, about;
    ``penalty``: cost of one more language in units of the logarithm of the
    number of n-grams; ``dense_languages``: up to so many languages the
    likelihoods are one dense table (512 KB a language), beyond that only the
    n-grams met in each language are kept, with equal results."""

    per_language: int = 2000
    dense_languages: int = 64
    smoothing: float = 0.05
    penalty: float = 3.0
    rounds: int = 12


@dataclass(frozen=True)
class Model:
    """Names of the languages, and the n-grams met in each: those of n-gram f
    are entries cuts[f] .. cuts[f + 1] - 1 (number of the language, count)."""

    settings: Settings
    names: list[str]
    cuts: np.ndarray
    lang: np.ndarray
    count: np.ndarray

    def likelihoods(self) -> Likelihoods:
        return Likelihoods(self)


def ngrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, count, cuts): text i has entries cuts[i] .. cuts[i + 1] - 1, ascending by feature."""
    rows = len(ends)
    owner = np.repeat(np.arange(rows), np.diff(ends, prepend=0))
    sign = _SYMBOL[data]
    keep = sign != 32
    if len(sign):
        keep[0] = True
        keep[1:] |= (sign[:-1] != 32) | (owner[1:] != owner[:-1])
    sign, owner = sign[keep], owner[keep]
    code = (sign[:-2] << 16 | sign[1:-1] << 8 | sign[2:]) if len(sign) > 2 else np.zeros(0, np.uint32)
    whole = owner[2:] == owner[:-2] if len(sign) > 2 else np.zeros(0, bool)
    tri = (code[whole] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    words, word_owner = word_hash.word_hashes(data, ends)
    feature = np.concatenate([tri.astype(np.int64), _HALF + (words & np.uint64(_HALF - 1)).astype(np.int64)])
    owners = np.concatenate([owner[2:][whole] if len(sign) > 2 else owner[:0], word_owner])
    keys = owners * _FEATURES + feature
    keys, counts = np.unique(keys.astype(np.uint32) if rows < 1 << 15 else keys, return_counts=True)
    keys = keys.astype(np.int64)
    return keys % _FEATURES, counts, np.searchsorted(keys, np.arange(rows + 1) * _FEATURES)


def _shares(relative: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Shares of the languages after EM, and the log likelihood (up to a constant of the text)."""
    share = np.full(relative.shape[1], 1.0 / relative.shape[1])
    total = counts.sum()
    if len(share) > 1:
        for _ in range(rounds):
            share = share * ((counts / (relative @ share)) @ relative) / total
            share /= share.sum()
    return share, float(counts @ np.log(relative @ share))


def infer(relative: np.ndarray, counts: np.ndarray, settings: Settings) -> tuple[int, float]:
    """(number of the predicted language, its share over all languages)."""
    every, _ = _shares(relative, counts, settings.rounds)
    order = np.argsort(-every, kind="stable")
    cost = settings.penalty * np.log(counts.sum() + 1.0)
    best, best_value = None, -np.inf
    for k in range(1, len(order) + 1):
        share, likelihood = _shares(relative[:, order[:k]], counts, settings.rounds)
        value = likelihood - cost * (k - 1)
        if value <= best_value:
            break
        best, best_value = share, value
    first = order[int(np.argmax(best))]
    return int(first), float(min(1.0, every[first]))


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from (id, text, lang) rows.  Rows with a null id, text or language are not learned from."""
    ship_package(labelled.sparkSession)
    usable = labelled.where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    sizes = materialize(usable.groupBy("lang").agg(F.count("*").alias("n")))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 53)).cast("double") / float(1 << 53)
    drawn = chance * F.col("n") < settings.per_language
    if sizes.count() <= BROADCAST_LANGUAGES:  # texts are drawn where they are
        sample = usable.join(F.broadcast(sizes), "lang").where(drawn)
    else:  # ids are drawn first, and texts meet them by id
        ids = usable.select("id", "lang").join(sizes, "lang").where(drawn).select("id", "lang").distinct()
        sample = usable.join(ids, ["id", "lang"])
    # Repeated rows of an id count once, so that they can't swell the sample.
    sample = sample.groupBy("id", "lang").agg(F.min(F.col("text").cast("binary")).alias("text")).select("lang", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = None, np.zeros(_FEATURES, np.int64)

        def learned():
            seen = np.flatnonzero(mine)
            return pa.RecordBatch.from_pydict({"lang": [held], "feature": [seen.astype(np.int32)], "count": [mine[seen]]})

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, rows, data, ends in word_hash.steps(batch.column(1)):
                feature, count, cuts = ngrams(data, ends)
                for i in range(rows):
                    if langs[at + i] != held:
                        if held is not None:
                            yield learned()
                        held, mine = langs[at + i], np.zeros(_FEATURES, np.int64)
                    mine[feature[cuts[i] : cuts[i + 1]]] += count[cuts[i] : cuts[i + 1]]
        if held is not None:
            yield learned()

    # A bounded sample per language: a language in one task, order does not matter for counts.
    dealt = sample.repartition("lang").sortWithinPartitions("lang")
    found = dealt.mapInArrow(learn, "lang string, feature array<int>, count array<bigint>").toArrow()  # at most 2 ** 17 counts a language
    order = np.argsort(np.array(found["lang"].to_pylist(), object)) if len(found) else []
    names = [found["lang"][int(i)].as_py() for i in order]
    parts = [(np.array(found["feature"][int(i)].values), np.array(found["count"][int(i)].values)) for i in order]
    feature = np.concatenate([np.zeros(0, np.int32), *[f for f, _ in parts]])
    lang = np.repeat(np.arange(len(parts), dtype=np.int32), [len(f) for f, _ in parts])
    count = np.concatenate([np.zeros(0, np.int64), *[c for _, c in parts]])
    by = np.argsort(feature, kind="stable")
    return Model(settings, names, np.searchsorted(feature[by], np.arange(_FEATURES + 1)), lang[by], count[by])


class Likelihoods:
    """Likelihoods of n-grams in every language, relative to the likeliest: rows of (n-gram, language)."""

    def __init__(self, model: Model):
        self.model, size = model, len(model.names)
        owner = np.repeat(np.arange(_FEATURES), np.diff(model.cuts)) // _HALF
        totals = np.bincount(owner * size + model.lang, model.count, 2 * size).reshape(2, size) if size else np.zeros((2, 0))
        self.smoothing = model.settings.smoothing
        self.totals = totals + self.smoothing * _HALF  # of trigrams and of words
        self.dense = self._rows(np.arange(_FEATURES)) if size <= model.settings.dense_languages else None

    def _rows(self, feature: np.ndarray) -> np.ndarray:
        begins, sizes = self.model.cuts[feature], np.diff(self.model.cuts)[feature]
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out = np.full((len(feature), len(self.model.names)), self.smoothing)
        out[np.repeat(np.arange(len(feature)), sizes), self.model.lang[at]] += self.model.count[at]
        out /= self.totals[feature // _HALF]
        return out / out.max(axis=1, keepdims=True) if out.size else out

    def __call__(self, feature: np.ndarray) -> np.ndarray:
        return self.dense[feature] if self.dense is not None else self._rows(feature)


def _has_letter(data: np.ndarray) -> bool:
    if _ASCII_LETTER[data].any():
        return True
    return bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def predict(model: Model, text: Column) -> Column:
    """A struct of lang_pred and score for a text column.

    A null text, one without a letter, or a model without a language gives
    ``und`` with score 0.  The whole text counts, whatever its length."""
    spark = SparkSession.active()
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    names, settings = model.names, model.settings

    @F.arrow_udf("lang_pred string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        likelihoods = shared.value.likelihoods()
        for column in batches:
            lang, score = [], []
            for _, rows, data, ends in word_hash.steps(column):
                feature, count, cuts = ngrams(data, ends)
                begin = 0
                for i in range(rows):
                    mine = slice(cuts[i], cuts[i + 1])
                    if not names or not _has_letter(data[begin : ends[i]]):
                        lang.append(UNDETERMINED)
                        score.append(0.0)
                    else:
                        first, share = infer(likelihoods(feature[mine]), count[mine].astype(np.float64), settings)
                        lang.append(names[first])
                        score.append(share)
                    begin = ends[i]
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return run(text.cast("binary"))


def held_out(doc_id: Column) -> Column:
    """True for rows that are never learned from: crc32 of the id as text is 2 modulo 4.  A null id is not held out (nor learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learn from the documents' own labels outside the held-out fold, predict
    all of them: doc_id, held_out, lang_pred, score.

    One row per input row, repeated rows too; null ids are predicted, not held
    out and not learned from.  Null, empty and letterless texts are ``und``.  An
    empty table gives an empty table; other columns are not read."""
    train = docs.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")
    out = docs.select("doc_id", predict(fit(train, settings), F.col("text")).alias("p"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")

"""A training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

    quality          documents that the classifier rejects go
    exact_dedup      of equal texts the row with the largest id stays
    near_dedup       one document of each SimHash component stays (the smallest id)
    mix              sources are sampled and repeated to their target weights
    pack             documents become pieces of sequences of at most 4096 tokens

Every stage is written as Parquet in the shared checkpoint folder and read
again as the next one's input, so a lost executor repeats one stage at most.
All but the last return the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.llm import exact_dedup, mixing, packing, quality, simhash
from tickwise.llm.queries import vocabulary_path
from tickwise.session import materialize
from tickwise.sources.tables import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on the labelled documents outside the held-out fold, keep what scores 0.3 or more."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"), "word", end_id=1, capacity=4096)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: SQL cannot express the classifier, the fingerprints, the sampling or the tokenizer: tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole corpus: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.  A document that the mix takes twice has
    its pieces twice, in sequences of their own."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs)
    return docs

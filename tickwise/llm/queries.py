"""Registered queries of the subpackage: thin wrappers that read a table, call the operator and shape its digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bitplanes, exact_dedup, kd_shards, langid, mixing, packing, prefix_trie, quality, simhash, token_files, topk, toxicity, warc


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(read_table(spark, sf_dir, "documents"))


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file (installed beside Spark on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), "word", end_id=1, capacity=4096)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read_table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_files.write_and_read(docs, vocabulary_path("byte_bpe_50k.json"), style="byte", end_id=0)


def op11_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = kd_shards.shard_documents(read_table(spark, sf_dir, "documents"), shards=8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


def op13_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster_rows(read_table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, seed=2, scale=256.0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix": op1_mix,
        "op2_toxicity": op2_toxicity,
        "op3_simhash": op3_simhash,
        "op4_pack": op4_pack,
        "op5_quality": op5_quality,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_topk": op7_topk,
        "op8_warc": op8_warc,
        "op9_language": op9_language,
        "op10_token_files": op10_token_files,
        "op11_kd_shards": op11_kd_shards,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_bitplane_clusters": op13_bitplane_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_dedup": exact_dedup.ORACLE_SQL,
        "op7_topk": topk.ORACLE_SQL,
        "op8_warc": warc.ORACLE_SQL,
        "op12_prefix_trie": prefix_trie.ORACLE_SQL,
        "op13_bitplane_clusters": bitplanes.oracle_sql(clusters=40, rounds=5, seed=2),
    }

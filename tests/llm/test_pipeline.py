"""The pipeline: every stage against brute force on its own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from test_mixing import check as check_mix
from test_simhash import slow_components, slow_fingerprint
from test_tokens import WORD, check_packing, slow_pieces
from tickwise.llm import mixing, quality, simhash
from tickwise.session import materialize

SF = "/root/testdata/sf0.001"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in cp.STAGES:
        made = materialize(stage(spark, docs, SF))
        out.append((docs, made))
        docs = made
    return out


def test_columns_and_contract(steps):
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]
    assert all(made.columns == docs.columns for docs, made in steps[:-1])


def test_quality_keeps_what_the_classifier_accepts(spark, steps):
    docs, made = steps[0]
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = quality.score_quality(docs, model).where("predicted = 1").select("doc_id")
    assert sorted(r.doc_id for r in made.collect()) == sorted(r.doc_id for r in want.collect())


def test_exact_dedup(steps):
    docs, made = steps[1]
    best = {}
    for r in docs.collect():
        best[fold(r.text)] = max(best.get(fold(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in made.collect()) == sorted(best.values())


def test_near_dedup(steps):
    docs, made = steps[2]
    rows = {r.doc_id: r for r in docs.collect()}
    groups = slow_components({i: slow_fingerprint(r.text) for i, r in rows.items()})
    kept = {r.doc_id: r for r in made.collect()}
    assert sorted(kept) == sorted({c for _, c in groups.values()})
    assert all(rows[i] == r for i, r in kept.items())


def test_mix(steps):
    docs, made = steps[3]
    rows = {r.doc_id: r for r in docs.collect()}
    check_mix([(r.doc_id, r.text, r.source) for r in rows.values()], mixing.mix_counts(docs).collect())
    taken = {r.doc_id: r.taken for r in mixing.mix_counts(docs).collect()}
    copies = {r.doc_id: r["count"] for r in made.groupBy("doc_id").count().collect()}
    assert all(taken[i] == copies.get(i, 0) * len(re.findall(r"[^\x20\x09-\x0D]+", rows[i].text or "")) for i in rows)
    assert all(rows[r.doc_id] == r for r in made.collect())


def test_pack(steps):
    docs, made = steps[4]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(made.collect(), slow_pieces(rows, WORD, 1, 4096), 4096)


def test_run_gives_the_last_stage(spark, steps):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, cp.run(spark, SF).select(names).collect())) == sorted(map(tuple, steps[-1][1].select(names).collect()))


def test_near_dedup_of_odd_rows(make_docs):
    long = "many words in a row " * 5000
    rows = [(1, None), (2, ""), (None, " "), (4, "a b c d"), (4, "A b c d"), (4, "a b c d"), (None, "alone here now"), (7, long), (7, long), (8, long + "x")]
    docs = make_docs(rows).withColumn("fp", F.lit("mine")).withColumn("hash", F.lit(1)).withColumn("n", F.lit(2))
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, len(r.text or "")) for r in out.collect()) == [(-1, 14), (1, 0), (4, 7), (7, len(long))]
    assert simhash.drop_near_duplicates(make_docs([])).count() == 0


def test_stages_take_an_empty_table(spark, make_docs):
    for _, stage in cp.STAGES:
        assert stage(spark, make_docs([]), SF).count() == 0


def test_stages_take_odd_rows_and_extra_columns(spark, make_docs):
    rows = [(None, None), (1, None), (1, None), (2, ""), (3, "Same Text here"), (4, "same text here"), (5, "long " * 20_000)]
    docs = make_docs(rows).withColumn("key", F.lit(1)).withColumn("source", F.lit(None).cast("string"))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= 2 * len(rows)
    assert cp.pack_sequences(spark, docs, SF).count() >= len(rows)

"""Exact deduplication: the split against a plain dictionary, and odd rows."""

import hashlib

from pyspark.sql import functions as F

from tickwise.llm import exact_dedup, heavy


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(fold(text), []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[fold(text)]
        known = [i for i in ids if i is not None]
        out.append((doc, max(known) if known else None, len(ids), hashlib.sha256(fold(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(i, "Hot copy") for i in range(300)] + [(1000 + i, f"text {i // 2} É") for i in range(200)] + [
    (5000, None), (5001, ""), (None, "only null id"), (None, "HOT copy"), (6000, "É"), (6001, "é"), (7000, "x" * 200_000), (7001, "X" * 200_000),
]


def test_decisions(make_docs):
    got = exact_dedup.dedup_decisions(make_docs(ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == slow(ROWS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_repeated_rows_keep_one(make_docs):
    rows = [(1, "a"), (1, "A"), (1, "a"), (2, "b"), (2, "b"), (3, "c"), (0, "c")]
    docs = make_docs(rows)
    assert exact_dedup.dedup_decisions(docs).where("kept").count() == 3
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text.lower()) for r in out.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_kept_rows_and_clashing_columns(make_docs):
    docs = make_docs(ROWS).withColumn("kept", F.lit("mine")).withColumn("group_size", F.lit(0)).withColumn("digest", F.lit("d"))
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    best = {}
    for doc, text in ROWS:
        best[fold(text)] = max(best.get(fold(text), -1), -1 if doc is None else doc)
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in out.collect()) == sorted(best.values())


def test_empty_table(make_docs):
    assert exact_dedup.dedup_decisions(make_docs([])).count() == 0
    assert exact_dedup.drop_exact_copies(make_docs([])).count() == 0


def test_frequent_digests_are_found(spark):
    rows = spark.range(60_000).select(F.expr("cast(case when id % 3 = 0 then 'hot' else cast(id as string) end as binary)").alias("d"))
    found = [bytes(r.d) for r in heavy.frequent_digests(rows, "d").collect()]
    assert b"hot" in found and len(found) <= heavy.MAX_FREQUENT


def test_frequent_digests_over_many_partitions(spark):
    rows = spark.range(40_000, numPartitions=500).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary").alias("d"))
    found = heavy.frequent_digests(rows, "d")
    assert b"hot" in [bytes(r.d) for r in found.collect()]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan

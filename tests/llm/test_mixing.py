"""Mixing: sizes and targets against plain Python, budgets, epochs and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickwise.llm import mixing, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(order)}
    left, budget, out = set(order), 1.5 * sum(sizes.values()), {}
    while left:
        level = budget / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * level > 2 * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in left}
        for s in over:
            out[s] = 2.0 * sizes[s]
            budget -= out[s]
            left.remove(s)
    return out


def check(rows, got):
    """rows: (doc_id, text, source); got: rows of mix_counts."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    goal = slow_targets(sizes)
    by_id = {i: (t, s) for i, t, s in rows}
    taken, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    assert sorted(r.doc_id for r in got) == sorted(by_id)
    for r in got:
        text, source = by_id[r.doc_id]
        assert r["size"] == words(text) and r.source_size == sizes[source]
        assert r.target == pytest.approx(goal[source], rel=1e-9, abs=1e-9)
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[source] += r.taken
        longest[source] = max(longest[source], r["size"])
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= longest[s] / 2 + 1e-6, s
    complete = {s: int(goal[s] // sizes[s]) if sizes[s] else 0 for s in sizes}
    assert all(r.taken >= complete[by_id[r.doc_id][1]] * r["size"] for r in got)


def test_query(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op1_mix(spark, SF).collect()
    check(rows, got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op1_mix(spark, SF).collect()))


def test_odd_rows_and_hot_source(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["b", "é", "a", None, "zz"])) for i in range(400)]
    rows += [(1000 + i, "tie tie", "hot") for i in range(500)] + [(5000, None, "empty"), (5001, "", "empty"), (5002, "long " * 30_000, "a"), (5003, "a\x1cb\x0bc d", None)]
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).repartition(7)
    check(rows, mixing.mix_counts(df).collect())


def test_mixed_documents_agree_with_counts(spark):
    rows = [(i, "x " * (i % 9), "en", "abc"[i % 3], 0) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("cut", F.lit(2))
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    for r in mixing.mix_counts(df).collect():
        assert r.taken == copies.get(r.doc_id, 0) * r["size"]


def test_repeated_null_and_empty(spark):
    rows = [(1, "a b", "en", "s", 0)] * 3 + [(None, "c d e", "en", None, 0), (None, None, None, None, None)]
    got = mixing.mix_counts(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 5 and len({r.taken for r in got if r.doc_id == 1}) == 1
    assert mixing.mix_counts(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], DOCS)).count() == 0

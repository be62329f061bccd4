"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickwise.llm import simhash
from tickwise.llm.components import components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        fold = fold.replace(c, " ")
    words = [w for w in fold.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=3):
    """{id: (fingerprint, component)} from {id: fingerprint}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def got(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query_against_brute_force(spark):
    from tickwise.llm.queries import op3_simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got(op3_simhash(spark, SF)) == slow_components({r.doc_id: slow_fingerprint(r.text) for r in docs})


def test_null_empty_ties_repeats(make_docs):
    rows = [(5, None), (3, ""), (9, " \t\n"), (1, "one"), (2, "ONE"), (2, "ONE"), (7, "x\x1cy z " * 3000)]
    df = simhash.near_duplicates(make_docs(rows))
    assert df.count() == 7
    assert got(df) == slow_components({i: slow_fingerprint(t) for i, t in rows})


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("crowd,bits", [(2, 3), (10_000, 3), (2, 2), (2, 1)])
def test_links_of_a_crowd(spark, crowd, bits):
    """Clusters around a few points: crowded segment values and plain ones give the components of all close pairs."""
    rng = random.Random(crowd)
    prints = {0}
    for _ in range(4):
        base = rng.getrandbits(64)
        for _ in range(40):
            p = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.add(p)
    ids = dict(enumerate(sorted(prints)))
    signed = [(i, int(np.uint64(p).astype(np.int64))) for i, p in ids.items()]
    df = spark.createDataFrame(signed, "id long, fp long")
    edges = simhash.links(df.select("fp"), bits, crowd)
    assert edges.where(F.col("a") == F.col("b")).count() == 0
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    ours = {}
    for i, p in signed:
        ours.setdefault(roots.get(p, p), set()).add(i)
    want = {}
    for i, (_, c) in slow_components(ids, bits).items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert roots == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}

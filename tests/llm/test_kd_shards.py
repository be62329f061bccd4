"""K-d tree shards: the tree against a plain recursion, and the law on odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tickwise.llm import kd_shards, queries

SF = "/root/testdata/sf0.001"


def slow_tree(points, dims, first, k, out):
    """points: (digest, part, weight, *coordinates)."""
    if k == 1 or not points:
        out.update({p[:2]: first for p in points})
        return
    widths = [max(p[3 + d] for p in points) - min(p[3 + d] for p in points) for d in range(dims)]
    axis = widths.index(max(widths)) if dims else None
    points = sorted(points, key=lambda p: (p[3 + axis] if dims else 0.0, p[0], p[1]))
    left, total, before, sides = k // 2, sum(p[2] for p in points), 0, ([], [])
    for p in points:
        sides[0 if (before + p[2] / 2) * k < total * left else 1].append(p)
        before += p[2]
    slow_tree(sides[0], dims, first, left, out)
    slow_tree(sides[1], dims, first + left, k - left, out)


@pytest.mark.parametrize("shards,dims", [(8, 3), (5, 2), (1, 2), (3, 0)])
def test_tree_against_recursion(spark, shards, dims):
    rng = random.Random(shards)
    points = [(bytes([i // 256, i % 256]), i % 3, rng.randint(1, 50), *[rng.choice([0.0, 0.25, rng.random()]) for _ in range(dims)]) for i in range(400)]
    names = [f"_x{i}" for i in range(dims)]
    schema = "digest binary, part bigint, weight bigint" + "".join(f", {n} double" for n in names)
    got = kd_shards.split_points(spark.createDataFrame(points, schema), names, shards).collect()
    want = {}
    slow_tree(points, dims, 0, shards, want)
    assert {(bytes(r.digest), r.part): r.shard for r in got} == want


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.op11_kd_shards(spark, SF).collect()
    text = {d.doc_id: (d.text or "").encode() for d in docs}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((i, len(t) + 1, zlib.crc32(t)) for i, t in text.items())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check_slots(rows)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)


def test_copies_stay_together_and_heavy_groups_are_dealt(make_docs, monkeypatch):
    monkeypatch.setattr(kd_shards, "GROUP_ROWS", 50)
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(20, 60) + str(i), "en", f"src{i % 5}", 10) for i in range(600)]
    rows += [(1000 + i, f"twice {i // 2}", "de", f"src{i % 7}", i) for i in range(100)]
    rows += [(2000 + i, "a third of all rows have this one text", "fr", "src0", 38) for i in range(400)]
    rows += [(5000 + i, "", None, None, None) for i in range(400)]
    got = kd_shards.shard_documents(make_docs(rows)).collect()
    assert len(got) == len(rows)
    check_slots(got)
    sizes, places = Counter(), defaultdict(set)
    for r in got:
        sizes[r.shard] += r.size
        places[r.text_crc32].add(r.shard)
    share = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - share) < 0.05 * share for s in sizes.values())
    assert all(len(places[zlib.crc32(f"twice {i}".encode())]) == 1 for i in range(50))
    assert len(places[zlib.crc32(rows[-401][1].encode())]) > 1


def test_odd_rows(make_docs, spark):
    rows = [(None, "a", None, None, None), (1, None), (1, ""), (2, "é"), (2, "é"), (3, "long " * 9000), (-5, "x", "en", "\U0001f600", -3)]
    got = kd_shards.shard_documents(make_docs(rows), shards=3).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), len((t or "").encode()) + 1) for i, t, *_ in rows)
    check_slots(got)
    assert kd_shards.shard_documents(make_docs([])).count() == 0
    clash = spark.createDataFrame([(i, f"t{i}", i, "x") for i in range(20)], "doc_id long, text string, shard long, digest string")
    got = kd_shards.shard_documents(clash, shards=None, target_bytes=20).collect()
    check_slots(got)
    assert Counter(r.shard for r in got).keys() <= set(range(4)) and len(got) == 20
    same = spark.createDataFrame([(7, "same")] * 50, "doc_id long, text string")
    assert max(Counter(r.shard for r in kd_shards.shard_documents(same, shards=4).collect()).values()) < 40

"""The conversation trie against a trie built in plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tickwise.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def slow(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            place = hashlib.sha256(f"{len(role.encode())} {role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role, place, text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ends[tuple(built[c])].append(c)
    out = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        childless = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)]
        saved = sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in below)
        digest = hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
        out[m[0], len(p)] = (members[p[:-1]][0] if p else None, len(m), sum(len(q) == len(p) + 1 for q in below), len(childless), saved, digest)
    return out


def ours(spark, rows, **options):
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), **options).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(2)
    rows = []
    for c in range(90, 330, 3):  # few different turns: many shared prefixes
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "hé", "ok"])) for t in range(rng.randint(0, 5))]
    rows += [(400 + i, t, "user", f"again {t}") for i in range(60) for t in range(4)]  # copies
    rows += [(77, t, "user", f"long {t % 3}") for t in range(120)]  # one long path
    return rows


@pytest.mark.parametrize("local_rows", [1 << 14, 4])
def test_against_plain_trie(spark, conversations, monkeypatch, local_rows):
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 20)
    assert ours(spark, conversations, local_rows=local_rows) == slow(conversations)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (1, None, None, None), (1, 2, "user", "b"), (1, 2, "user", "b"), (1, 2, "bot", "c"), (1, -1, "a", ""),
        (-5, 0, "user", "x" * 20000), (100, 0, "user", "first"), (101, 0, "user", "own"), (102, 0, "user", "own"), (250, 9, "", "user"), (251, 9, "user", ""),
    ]
    assert ours(spark, rows) == slow(rows)
    assert ours(spark, []) == {}


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "u", "t", 5, "x")], "conv_id long, turn long, role string, text string, depth long, c string")
    assert prefix_trie.conversation_trie(df).count() >= 1


def test_centroid_sums_against_plain_sums():
    rng = random.Random(5)
    for shape in ("bush", "path", "star"):
        for n in (1, 2, 7, 200):
            parent = [-1] + [{"bush": rng.randrange(i), "path": i - 1, "star": 0}[shape] for i in range(1, n)]
            values = np.array([[rng.randint(-5, 9), i] for i in range(n)], np.int64)
            want = values.copy()
            for v in range(n - 1, 0, -1):
                want[parent[v]] += want[v]
            assert (prefix_trie.centroid_sums(parent, values) == want).all()

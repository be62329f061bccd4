"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct prefix of turns; a conversation is a member of every
prefix of its own.  Nodes are named by (smallest member, depth), which is
unique.

**Building.**  Every turn becomes a hash of its place and content, and a
prefix is known by the running sum of those hashes (four sums modulo 2^28 of
SHA-256 pieces, 112 bits): running sums are taken in bounded chunks, so a
conversation with a third of all turns is no longer one task's work than any
other.  Grouping rows by (depth, sums) gives the nodes.

**Rolling up.**  The sum of a value over every subtree is taken by centroid
decomposition of the forest of parent edges.  The weight of a node is its
number of members; what a subtree weighs -- the rows that go through it -- is
known when the nodes are made, so each component's centroid (the deepest node
whose subtree holds more than half of the component) is found by one
aggregation.  Removing it leaves components of at most half the weight: one
per child, and the part above.  The total below the centroid is added to the
nodes on the path from the centroid to the top of its component; everything
else is left to the parts.  So a path with a third of all nodes takes as many
rounds as a bush.  Components of up to ``local_rows`` are finished by the same
recursion inside one task each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.series import prefix_sum, sequence_rows
from ..session import materialize, ship_package
from .heavy import HOT_SHARE, join_hot

#: Rows of a component that one task finishes.
LOCAL_ROWS = 1 << 14
#: Bytes of a chunk of member ids hashed as one piece.
CHUNK_BYTES = 1 << 16

_PIECES, _BITS = 4, 28
_SUMS = [f"s{i}" for i in range(_PIECES)]
_KEY = ["depth", *_SUMS]


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, place from 1, content hash, code points): turns in order (null first; ties by role and text), null role or text empty."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(" "), "role", "text"), 256)
    narrow = rows.select("c", "turn", "role", content.alias("content"), F.length("text").cast("bigint").alias("points"))
    return sequence_rows(narrow, ["c"], ["turn", "role", "content"], seq_col="place").select("c", "place", "content", "points")


def rebuild(turns: DataFrame, most: int = 6, block: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their block does:
    (rows: c, place, content, points; ends: c, turns).

    ``turns`` is the written result of ``numbered_turns``.  The first h turns
    of conversation c - c % block (h = crc32 of c in decimal modulo ``most``)
    are followed by c's own turns after its first h."""
    own = turns.groupBy("c").agg(F.count("*").alias("own_turns"))
    c = own.select("c", "own_turns", (F.crc32(F.col("c").cast("string").cast("binary")) % most).alias("h"), (F.col("c") - F.col("c") % block).alias("base"))
    base = turns.where((F.col("c") % block == 0) & (F.col("place") < most))
    given = base.groupBy("c").agg(F.count("*").alias("given")).select(F.col("c").alias("base"), "given")
    c = materialize(c.join(given, "base", "left").withColumn("taken", F.least("h", F.coalesce("given", F.lit(0)))))
    begin = base.select(F.col("c").alias("base"), "place", "content", "points")
    # At most ``block`` conversations and ``most`` - 1 turns share a base.
    first = c.where("taken > 0").select("c", "base", "taken").join(begin, "base").where("place <= taken").select("c", "place", "content", "points")
    long = c.where(F.col("own_turns") > F.lit(turns.count() // HOT_SHARE)).select("c")
    rest = join_hot(turns, c.select("c", "h", "taken"), ["c"], long).where("place > h")
    rest = rest.select("c", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "content", "points")
    ends = c.select("c", (F.col("taken") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0))).alias("turns"))
    return first.unionByName(rest), ends


def _prefixes(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Every prefix of every conversation: depth, sums, those of its parent, c, points of its last turn, rows below (itself included)."""
    piece = lambda i: F.conv(F.substring(F.sha2(F.concat(F.col("place").cast("string"), F.lit(" "), "content"), 256), 1 + 7 * i, 7), 16, 10).cast("bigint")
    terms = rows.select("c", "place", "points", *[piece(i).alias(f"t{i}") for i in range(_PIECES)])
    summed = prefix_sum(terms, ["c"], {s: F.col(f"t{i}") for i, s in enumerate(_SUMS)}, seq_col="place")
    modulus = F.lit(1 << _BITS)
    now = [F.pmod(F.col(s), modulus).alias(s) for s in _SUMS]
    before = [F.pmod(F.col(s) - F.col(f"t{i}"), modulus).alias(f"p{i}") for i, s in enumerate(_SUMS)]
    deep = summed.select("c", F.col("place").alias("depth"), "points", *now, *before)
    root = ends.select("c", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("points"),
                       *[F.lit(0).cast("bigint").alias(s) for s in _SUMS], *[F.lit(None).cast("bigint").alias(f"p{i}") for i in range(_PIECES)])
    return deep.unionByName(root)


def _ends_hashes(ends: DataFrame) -> DataFrame:
    """(key, SHA-256 of the ids that end there, ascending, comma-joined).

    Ids are joined into chunks of text where they were sorted, range by range;
    one stream per node then hashes its few chunks in order."""
    key_of = lambda batch: list(zip(*[batch.column(i).to_pylist() for i in range(len(_KEY))]))
    kinds = ", ".join(f"{k} bigint" for k in _KEY)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, parts, size, out = None, None, [], 0, []

        def close():
            if held is not None:
                out.append((*held, first, ",".join(parts)))

        for batch in batches:
            for key, c in zip(key_of(batch), batch.column(len(_KEY)).to_pylist()):
                if key != held or size > CHUNK_BYTES:
                    close()
                    held, first, parts, size = key, c, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield _batch(out)
                out = []
        close()
        if out:
            yield _batch(out)

    def _batch(rows):
        arrays = [pa.array(x, pa.int64()) for x in list(zip(*rows))[:-1]] + [pa.array([r[-1] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [*_KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, out = None, None, []
        for batch in batches:
            for key, ids in zip(key_of(batch), batch.column(len(_KEY) + 1)):
                if key != held:
                    if held is not None:
                        out.append((*held, state.hexdigest()))
                    held, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            if out:
                yield _hashes(out)
                out = []
        if held is not None:
            yield _hashes([*out, (*held, state.hexdigest())])

    def _hashes(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in columns[:-1]], pa.array(columns[-1], pa.string())], [*_KEY, "ends_sha256"])

    order = [*_KEY, "c"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, f"{kinds}, first bigint, ids string")
    return chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(digest, f"{kinds}, ends_sha256 string")


# ---- subtree sums ------------------------------------------------------------------------------


def centroid_sums(parent: list[int], values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` over every subtree of a tree given by
    parent positions (-1: the top; parents come before their children).

    Each component's centroid is removed, what hangs below it is added along
    the path to the component's top, and the parts follow in turn."""
    n = len(parent)
    sums = np.zeros_like(values)
    children: list[list[int]] = [[] for _ in range(n)]
    for v, p in enumerate(parent):
        if p >= 0:
            children[p].append(v)
    gone = np.zeros(n, bool)
    todo = [v for v, p in enumerate(parent) if p < 0]
    while todo:
        top = todo.pop()
        order = [top]
        for v in order:  # grows: the component below ``top``
            order += [c for c in children[v] if not gone[c]]
        size, below = dict.fromkeys(order, 1), {v: values[v].copy() for v in order}
        for v in reversed(order[1:]):
            size[parent[v]] += size[v]
            below[parent[v]] += below[v]
        half, centroid = len(order) / 2, top
        while True:
            heavy = next((c for c in children[centroid] if not gone[c] and size[c] > half), None)
            if heavy is None:
                break
            centroid = heavy
        total, v = below[centroid], centroid
        while True:
            sums[v] += total
            if v == top:
                break
            v = parent[v]
        gone[centroid] = True
        todo += [c for c in children[centroid] if not gone[c]]
        if centroid != top:
            todo.append(top)
    return sums


def _local_sums(parts: DataFrame, values: list[str]) -> DataFrame:
    """(c, depth, values): subtree sums inside each component (top_c, top_depth), of bounded size, in one task each."""
    schema = "c bigint, depth bigint, " + ", ".join(f"{v} bigint" for v in values)

    def solve(rows: list[tuple]) -> list[tuple]:
        place = {(r[0], r[1]): i for i, r in enumerate(rows)}  # rows come by depth
        parent = [place.get((r[2], r[1] - 1), -1) for r in rows]
        sums = centroid_sums(parent, np.array([r[3:] for r in rows], np.int64))
        return [(r[0], r[1], *s) for r, s in zip(rows, sums.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c", "depth", *values]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

        held, rows, out = None, [], []
        for batch in batches:
            columns = [x.to_pylist() for x in batch.columns]
            for top_c, top_depth, *row in zip(*columns):
                if (top_c, top_depth) != held:
                    out += solve(rows)
                    held, rows = (top_c, top_depth), []
                rows.append(tuple(row))
            if out:
                yield made(out)
                out = []
        out += solve(rows)
        if out:
            yield made(out)

    narrow = parts.select("top_c", "top_depth", "c", "depth", "parent_c", *values)
    return narrow.repartition("top_c", "top_depth").sortWithinPartitions("top_c", "top_depth", "depth", "c").mapInArrow(run, schema)


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(c, depth, values summed over the node's subtree).

    ``nodes``: c, depth, parent_c, weight, below (weight of the subtree) and
    the values.  ``paths``: (c, depth, node): which conversation names the node
    at each depth of conversation c.  Both are written tables of one tree.  At
    most (total weight / ``local_rows``) components are split in a round; the
    table of their centroids is broadcast, and each round halves them."""
    top = nodes.where("depth = 0").select(F.col("c").alias("top_c"), F.lit(0).cast("bigint").alias("top_depth"))
    part = materialize(nodes.select("c", "depth", "parent_c", "weight", "below", *values).join(F.broadcast(top)))  # one top
    paths_rows = paths.count()
    done, added = [], []
    comp = ["top_c", "top_depth"]
    while True:
        totals = part.groupBy(*comp).agg(F.max("below").alias("total")).where(F.col("total") > local_rows)
        totals = materialize(totals)
        if totals.isEmpty():
            done.append(part)
            break
        large = part.join(F.broadcast(totals), comp)
        done.append(part.join(F.broadcast(totals.select(*comp)), comp, "left_anti"))
        heaviest = large.where(F.col("below") * 2 > F.col("total")).groupBy(*comp).agg(F.max(F.struct("depth", "c", "below")).alias("z"))
        centroids = materialize(heaviest.select(*comp, F.col("z.depth").alias("z_depth"), F.col("z.c").alias("z_c"), F.col("z.below").alias("z_below")))
        # All nodes that one conversation names lie on one path: whether they are below the centroid is asked once for them.
        owners = large.groupBy("c", *comp).agg(F.count("*").alias("n")).join(F.broadcast(centroids), comp)
        at = paths.select("c", F.col("depth").alias("z_depth"), F.col("node").alias("at_z"))
        after = paths.select("c", (F.col("depth") - 1).alias("z_depth"), F.col("node").alias("next_c"))
        state = owners.join(at, ["c", "z_depth"], "left").join(after, ["c", "z_depth"], "left")
        state = materialize(state.select("c", *comp, "n", "z_depth", "z_c", F.coalesce(F.col("at_z") == F.col("z_c"), F.lit(False)).alias("under"), "next_c"))
        crowded = state.where(F.col("n") > F.lit(paths_rows // HOT_SHARE)).select("c", *comp)
        placed = join_hot(large.drop("total"), state.drop("n"), ["c", *comp], crowded)
        placed = materialize(placed.withColumn("inside", F.col("under") & (F.col("depth") >= F.col("z_depth"))))
        sums = [F.sum(v).alias(f"z_{v}") for v in values]
        below = placed.where("inside").groupBy(*comp).agg(*sums)
        moved = centroids.join(below, comp)  # a row per centroid
        along = paths.join(F.broadcast(moved.withColumnRenamed("z_c", "c")), "c").where("depth <= z_depth AND depth >= top_depth")
        along = materialize(along.select(F.col("node").alias("c"), "depth", "z_below", *[F.col(f"z_{v}").alias(v) for v in values]))
        added.append(along.select("c", "depth", *values))
        upper = placed.where("NOT inside").join(along.select("c", "depth", F.col("z_below").alias("less")), ["c", "depth"], "left")
        upper = upper.withColumn("below", F.col("below") - F.coalesce("less", F.lit(0)))
        lower = placed.where("inside AND depth > z_depth").withColumn("top_c", F.col("next_c")).withColumn("top_depth", F.col("z_depth") + 1)
        keep = ["c", "depth", "parent_c", "weight", "below", *values, *comp]
        part = materialize(upper.select(*keep).unionByName(lower.select(*keep)))
    sums = None
    for rows in [*[_local_sums(p, values) for p in done], *added]:
        sums = rows if sums is None else sums.unionByName(rows)
    return sums.groupBy("c", "depth").agg(*[F.sum(v).alias(v) for v in values])


# ---- the trie ------------------------------------------------------------------------------------


def trie(rows: DataFrame, ends: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The nodes of conversations given as (c, place 1.., content, points) and (c, turns)."""
    ship_package(rows.sparkSession)
    ends = materialize(ends)
    total = ends.agg(F.sum(F.col("turns") + 1)).first()[0] or 0
    long = ends.where(F.col("turns") > F.lit(total // HOT_SHARE)).select("c")
    every = materialize(join_hot(_prefixes(rows, ends), ends.select("c", "turns"), ["c"], long))
    parents = [F.first(f"p{i}").alias(f"p{i}") for i in range(_PIECES)]
    nodes = every.groupBy(*_KEY).agg(
        F.min("c").alias("c"), F.count("*").alias("weight"), F.sum(F.col("turns") - F.col("depth") + 1).alias("below"), F.first("points").alias("points"), *parents
    )
    nodes = materialize(nodes)
    up = ["depth", *[f"p{i}" for i in range(_PIECES)]]
    counts = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    counts = materialize(counts.select((F.col("depth") - 1).alias("depth"), *[F.col(f"p{i}").alias(s) for i, s in enumerate(_SUMS)], "n_children"))
    # Names of the parents; a node with very many children is joined map-side.
    names = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"p{i}") for i, s in enumerate(_SUMS)], F.col("c").alias("parent_c"))
    fruitful = counts.where(F.col("n_children") > F.lit(total // HOT_SHARE))
    fruitful = fruitful.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"p{i}") for i, s in enumerate(_SUMS)])
    named = join_hot(nodes.where("depth > 0"), names, up, fruitful).unionByName(nodes.where("depth = 0").withColumn("parent_c", F.lit(None).cast("bigint")))
    childless = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint")
    named = materialize(
        named.join(counts, _KEY, "left").select(
            *_KEY, "c", "parent_c", "weight", "below", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            childless.alias("leaves"), ((F.col("weight") - 1) * F.col("points")).alias("saved"),
        )
    )
    # Which conversation names the node at each depth of every conversation that names any.
    crowded = named.where(F.col("weight") > F.lit(total // HOT_SHARE)).select(*_KEY)
    owned = join_hot(every.select("c", *_KEY), named.select("c").distinct(), ["c"], long)
    paths = materialize(join_hot(owned, named.select(*_KEY, F.col("c").alias("node")), _KEY, crowded).select("c", "depth", "node"))
    sums = subtree_sums(named.drop(*_SUMS), paths, ["leaves", "saved"], local_rows)
    hashes = _ends_hashes(every.where("depth = turns"))
    empty = hashlib.sha256(b"").hexdigest()
    out = named.drop("leaves", "saved").join(sums, ["c", "depth"]).join(hashes, _KEY, "left")
    return out.select(
        F.col("c").alias("conv_id"), "depth", F.col("parent_c").alias("parent_conv_id"), F.col("weight").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, most: int = 6, block: int = 100, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (see ``rebuild``): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conversation id belong to no conversation and are left out.
    Null turns come first, null roles and texts are empty, turns of one number
    are ordered by role and then by a hash of role and text, and repeated rows
    are turns of their own.  A conversation may end up without turns: it is a
    member of the root alone.  An empty table gives an empty table; other
    columns are not read."""
    ship_package(turns.sparkSession)
    numbered = materialize(numbered_turns(turns))
    rows, ends = rebuild(numbered, most, block)
    return trie(rows, ends, local_rows)


#: crc32 of a text of ASCII digits, a bit at a time.
_CRC_SQL = (
    "xor(4294967295::UBIGINT, list_reduce([4294967295::UBIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT), "
    "lambda crc, b: list_reduce([xor(crc, b)] || range(8)::UBIGINT[], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)))"
)

ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT c, turns, ({_CRC_SQL} % 6)::BIGINT AS h FROM own),
built AS (
  SELECT h.c, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns FROM h LEFT JOIN own b ON b.c = h.c - h.c % 100
), every AS (
  SELECT c, d, turns[1:d] AS prefix, len(turns) = d AS ends FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built) u
), node AS (
  SELECT d, prefix, min(c) AS c, count(*) AS n,
         sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM every GROUP BY d, prefix
), named AS (
  SELECT n.*, p.c AS parent_c, CASE WHEN n.d > 0 THEN (n.n - 1) * length(n.prefix[n.d].t) ELSE 0 END AS saved
  FROM node n LEFT JOIN node p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
), kids AS (SELECT parent_c AS c, d - 1 AS d, count(*) AS k FROM named WHERE d > 0 GROUP BY ALL),
path AS (SELECT e.c, e.d, n.c AS node FROM every e JOIN node n ON n.d = e.d AND n.prefix = e.prefix),
total AS (
  SELECT q.node AS c, q.d, sum(CASE WHEN k.k IS NULL THEN 1 ELSE 0 END) AS leaves, sum(v.saved) AS saved
  FROM named v LEFT JOIN kids k ON k.c = v.c AND k.d = v.d JOIN path q ON q.c = v.c AND q.d <= v.d GROUP BY ALL
)
SELECT v.c AS conv_id, v.d AS depth, v.parent_c AS parent_conv_id, v.n AS n_convs, coalesce(k.k, 0) AS n_children,
       t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM named v JOIN total t ON t.c = v.c AND t.d = v.d LEFT JOIN kids k ON k.c = v.c AND k.d = v.d
"""

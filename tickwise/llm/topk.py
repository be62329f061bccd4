"""Exact top-k inner-product search by ball-tree branch and bound.

Vectors are dealt into shards of bounded size.  A task lays out its shard,
builds a ball tree over it and answers the queries that follow in blocks.  A
node's ball bounds every inner product below it by  q . centre + |q| * radius;
nodes are taken in order of that bound and dropped when it can't beat the
query's current k-th best.

The k-th score is shared between shards: in the first wave each query searches
one shard, and the k-th score found there is the starting bound for all other
shards in the second wave, which therefore return only rows that can still
matter.  A query's candidates are merged by one bounded window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Vector components a shard holds, about (8 bytes each).
SHARD_COMPONENTS = 1 << 20
LEAF_ROWS = 64
_EXACT = float(1 << 53)
_LOWEST = -(1 << 63)


class BallTree:
    """Balls over integer vectors, in arrays; rows are reordered so that a node is a range of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.size = float(np.abs(vectors).max(initial=0.0))
        order = np.arange(len(ids))
        centre, radius, self.begin, self.end, self.second, self.least = [], [], [], [], [], []
        todo = [(0, len(ids), -1)]
        while todo:  # preorder: a node's first child is the next node
            lo, hi, parent = todo.pop()
            node, rows = len(centre), order[lo:hi]
            points = vectors[rows]
            mid = points.mean(axis=0)
            away = ((points - mid) ** 2).sum(axis=1)
            centre.append(mid)
            radius.append(float(np.sqrt(away.max())))
            self.begin.append(lo)
            self.end.append(hi)
            self.least.append(int(ids[rows].min()))
            self.second.append(-1)
            if parent >= 0:
                self.second[parent] = node
            same = not (points != points[0]).any()
            if same:
                order[lo:hi] = rows[np.argsort(ids[rows], kind="stable")]
            elif hi - lo > LEAF_ROWS:
                one = points[away.argmax()]
                other = points[((points - one) ** 2).sum(axis=1).argmax()]
                cut = (lo + hi) // 2
                order[lo:hi] = rows[np.argpartition(points @ (other - one), cut - lo)]
                todo += [(cut, hi, node), (lo, cut, -1)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.centre, self.radius = np.array(centre), np.array(radius)

    def search(self, query: int, vector: np.ndarray, bounds: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """The k best (score, -id) of this shard for a query, ties to the
        smaller id, without the query's own rows and those below ``floor``."""
        best: list[tuple[int, int]] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            bar = best[0][0] if len(best) == k else floor  # bounds and scores are cut to a long's range before they meet it
            if -bound < bar:
                break
            if len(best) == k and np.floor(-bound) <= bar and self.least[node] > -best[0][1]:
                continue  # at most a tie, and every id here is larger
            if self.second[node] >= 0:
                for down in (node + 1, self.second[node]):
                    if bounds[down] >= bar:
                        heapq.heappush(heap, (-bounds[down], down))
                continue
            lo, hi = self.begin[node], self.end[node]
            if self.radius[node] == 0 and hi - lo > k:  # one vector many times, ascending ids
                others = np.flatnonzero(self.ids[lo:hi] != query)[:k] + lo
            else:
                others = np.arange(lo, hi)
            scores = self._scores(others, vector)
            for at in np.flatnonzero(scores >= bar):
                id_ = int(self.ids[others[at]])
                found = (int(scores[at]), -id_)
                if id_ == query:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return best

    def _scores(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        if self.size * float(np.abs(vector).max(initial=0.0)) * max(1, len(vector)) < _EXACT:
            return self.vectors[rows] @ vector  # exact: every sum is an integer below 2 ** 53
        whole = [int(x) for x in vector]
        exact = (sum(int(a) * b for a, b in zip(row, whole)) for row in self.vectors[rows])
        return np.array([max(_LOWEST, min(-_LOWEST - 1, x)) for x in exact], object)

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        """Upper bound of every node's scores for each query, a little above rounding."""
        norms = np.sqrt((vectors**2).sum(axis=1))[:, None]
        reach = np.sqrt((self.centre**2).sum(axis=1)) + self.radius
        bounds = vectors @ self.centre.T + norms * self.radius + norms * reach * 1e-9 + 1e-6
        return np.maximum(np.nan_to_num(bounds, nan=np.inf, posinf=np.inf), float(_LOWEST))


def scaled(vector: Column) -> Column:
    """floor(1024 * x) per component as whole doubles, or null for a vector
    that takes no part (null, or with a null or non-finite component or product)."""
    parts = F.transform(vector, lambda x: F.expr("1024D") * x.cast("double"))
    floor = lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)  # noqa: E731  larger doubles are whole
    whole = F.transform(parts, lambda x: F.when((x > float("-inf")) & (x < float("inf")), floor(x)))
    return F.when(vector.isNotNull() & ~F.exists(whole, lambda x: x.isNull()), whole)


def _search(rows: DataFrame, k: int, shards: int) -> DataFrame:
    """(query_id, vec_id, score) from rows (shard, dims, kind 0: vector / 1: query, id, vec, floor), one shard after another in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, vectors, tree = None, [], [], None
        for batch in batches:
            shard, dims, kind, id_ = (batch.column(i).to_numpy() for i in range(4))
            vec, floor = batch.column(4), batch.column(5).to_numpy()
            flat, at = vec.values.to_numpy(), vec.offsets.to_numpy()
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(dims) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                if lo == hi:
                    continue
                if place != (shard[lo], dims[lo]):
                    place, ids, vectors, tree = (shard[lo], dims[lo]), [], [], None
                block = flat[at[lo] : at[hi]].reshape(hi - lo, dims[lo])
                if kind[lo] == 0:
                    ids.append(id_[lo:hi])
                    vectors.append(block)
                    continue
                if not ids:
                    continue
                tree = tree or BallTree(np.concatenate(ids), np.concatenate(vectors))
                for first in range(0, hi - lo, 256):
                    some = block[first : first + 256]
                    bounds = tree.bounds(some)
                    out = []
                    for i in range(len(some)):
                        q = int(id_[lo + first + i])
                        out += [(q, -n, s) for s, n in tree.search(q, some[i], bounds[i], k, int(floor[lo + first + i]))]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"])

    dealt = rows.repartition(shards, "shard", "dims").sortWithinPartitions("shard", "dims", "kind", "id")
    return dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def search(
    vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    shard_components: int = SHARD_COMPONENTS,
) -> DataFrame:
    """For every query (a row where ``queries`` holds) its k highest integer
    inner products with all other rows: query_id, rank, vec_id, score; ties to
    the smaller id, all rows if there are fewer than k.

    Rows with a null id, and vectors that are null or hold null or non-finite
    components, take no part.  Vectors meet vectors of their own length only.
    Repeated rows are candidates of their own, but rows with the query's id
    never are; repeated query rows are one query (the smallest vector).  Scores beyond a long are cut to
    its range.  An empty table gives an empty table."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vec_col)).alias("vec"), queries.alias("asked"))
    rows = materialize(rows.where("id IS NOT NULL AND vec IS NOT NULL").withColumn("dims", F.size("vec")))
    total = rows.agg(F.sum("dims")).first()[0] or 0
    shards = max(1, -(-total // shard_components))
    home = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards))
    stored = materialize(rows.select(home.alias("shard"), "dims", F.lit(0).alias("kind"), "id", "vec", F.lit(_LOWEST).alias("floor")))
    asked = rows.where("asked").groupBy("dims", "id").agg(F.min("vec").alias("vec"))
    asked = materialize(
        asked.groupBy("id").agg(F.min(F.struct("dims", "vec")).alias("q")).select("id", "q.dims", "q.vec")
        .withColumn("home", F.pmod(F.xxhash64("id"), F.lit(shards)))
    )
    first = asked.select(F.col("home").alias("shard"), "dims", F.lit(1).alias("kind"), "id", "vec", F.lit(_LOWEST).alias("floor"))
    found = _search(stored.unionByName(first), k, shards)
    if shards > 1:
        found = materialize(found)
        kth = found.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
        kth = kth.where(F.col("n") >= k).select(F.col("query_id").alias("_q"), "least")
        elsewhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        second = asked.join(kth, F.col("id") == F.col("_q"), "left").select("*", elsewhere).where("shard <> home").select(
            F.col("shard").cast("long").alias("shard"), "dims", F.lit(1).alias("kind"), "id", "vec", F.coalesce("least", F.lit(_LOWEST)).alias("floor")
        )
        found = found.unionByName(_search(stored.unionByName(second), k, shards))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows a shard
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

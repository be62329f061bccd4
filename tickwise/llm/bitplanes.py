"""Centroid clustering on bit planes.

A vector of 64 integers is stored as its bit planes: plane j packs bit j of
every component into one 64-bit word, in two's complement, so the last plane
weighs -2^j and every other one 2^j.  Then

    v . c  =  sum over planes i of v, j of c:  w_i * w_j * popcount(V_i & C_j)

is exact in integers, and with |v|^2 and |c|^2, which are dot products too, so
is the squared distance.  A vector has as many planes as its own widest
component needs: ordinary vectors take about ten, and a vector with huge
components pays for itself alone.

Centroid sums come from the planes as well: the sum of component d over a
cluster is the sum over planes of their weight times the number of vectors
with bit d set, and those counts are all that a task reports -- at most
(clusters x planes) rows of 64 counts, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Components of a vector: the bits of a word.
WORD = 64
#: Planes up to which weights and sums of a dot product stay within a long.
_LONG_PLANES = 28
_MOST = (1 << 63) - 1
#: Vectors whose distances are taken at a time.
_STEP = 4096


def usable(vector: Column) -> Column:
    """True for a vector of exactly 64 components, none of them null or non-finite."""
    fault = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) == WORD) & ~fault, F.lit(False))


def _whole(row: np.ndarray, scale: float) -> list[int]:
    """floor(scale * x) as integers of any size; the product is exact to a double, or taken exactly if it overflows."""
    with np.errstate(over="ignore"):
        product = row * scale
    if np.isfinite(product).all():
        return [int(x) for x in np.floor(product).tolist()]
    return [int(x) * int(scale) if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in row.tolist()]


def width(values: list[int]) -> int:
    """Planes that hold the integers in two's complement."""
    return 1 + max(max(v, ~v).bit_length() for v in values)


def planes_of(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, 64) integers -> (rows, planes) words; bit d of word j is bit j of component d."""
    bits = np.stack([((values >> j) & 1).astype(np.uint8) for j in range(planes)], axis=1)
    return np.packbits(bits, axis=2, bitorder="little").reshape(len(values), planes, 8).copy().view("<u8")[:, :, 0]


def pack(vectors: np.ndarray, scale: float) -> list[np.ndarray]:
    """The planes of floor(scale * x) for each row of doubles."""
    out: list[np.ndarray | None] = [None] * len(vectors)
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    small = (np.abs(scaled) < 1 << 50).all(axis=1)
    whole = np.where(small[:, None], scaled, 0).astype(np.int64)
    widths = np.array([int(x).bit_length() + 1 for x in np.maximum(whole, ~whole).max(axis=1, initial=0)])
    for w in np.unique(widths[small]).tolist():
        rows = np.flatnonzero(small & (widths == w))
        for i, p in zip(rows.tolist(), planes_of(whole[rows], w)):
            out[i] = p
    for i in np.flatnonzero(~small).tolist():
        values = _whole(vectors[i], scale)
        out[i] = planes_of(np.array([values], object), width(values))[0]
    return out  # type: ignore[return-value]


def unpack(planes: np.ndarray) -> list[int]:
    """The 64 integers of one vector's planes."""
    bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(len(planes), 8), axis=1, bitorder="little")
    return [sum(int(b) << j for j, b in enumerate(column[:-1])) - (int(column[-1]) << (len(column) - 1)) for column in bits.T.tolist()]


def _weighted(p: int, q: int, shape: tuple[int, ...], common: Callable[[int, int], np.ndarray]) -> np.ndarray:
    """Sum over plane pairs (i of p, j of q) of their weight times ``common(i, j)``, popcounts of at most 64.

    Pairs of one weight are counted together before they are weighted; a pair
    with just one sign plane counts negative."""
    total = np.zeros(shape, np.int64)
    for weight in range(p + q - 1):
        for negative in (False, True):
            pairs = [(i, weight - i) for i in range(max(0, weight - q + 1), min(p, weight + 1)) if ((i == p - 1) != (weight - i == q - 1)) == negative]
            if pairs:
                count = np.zeros(shape, np.uint16)
                for i, j in pairs:
                    count += common(i, j)
                total += count.astype(np.int64) * (-(1 << weight) if negative else 1 << weight)
    return total


def _wide_dot(v: np.ndarray, c: np.ndarray) -> int:
    """The dot product of two vectors of any number of planes, as a Python integer."""
    count = np.bitwise_count(v[:, None] & c[None, :]).astype(np.int64)
    count[-1, :-1] *= -1
    count[:-1, -1] *= -1
    weights = np.add.outer(np.arange(len(v)), np.arange(len(c)))
    sums = np.bincount(weights.ravel(), count.ravel())  # exact: far below 2 ** 53
    return sum(int(n) << w for w, n in enumerate(sums.tolist()) if n)


def _objects(values: list, shape: tuple[int, ...]) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out.reshape(shape)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of rows of ``a`` (n, planes) with rows of ``b`` (m, planes): longs where they hold, else Python integers."""
    if max(a.shape[1], b.shape[1]) > _LONG_PLANES:
        return _objects([_wide_dot(v, c) for v in a for c in b], (len(a), len(b)))
    columns = [np.ascontiguousarray(a[:, i, None]) for i in range(a.shape[1])]
    others = [np.ascontiguousarray(b[None, :, j]) for j in range(b.shape[1])]
    return _weighted(len(columns), len(others), (len(a), len(b)), lambda i, j: np.bitwise_count(columns[i] & others[j]))


def _norms(a: np.ndarray) -> np.ndarray:
    """|a|^2 row by row."""
    if a.shape[1] > _LONG_PLANES:
        return _objects([_wide_dot(v, v) for v in a], (len(a),))
    columns = [np.ascontiguousarray(a[:, i]) for i in range(a.shape[1])]
    return _weighted(len(columns), len(columns), (len(a),), lambda i, j: np.bitwise_count(columns[i] & columns[j]))


def nearest(rows: np.ndarray, centroids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of vectors of one width; ties to the smaller number."""
    norms = _norms(rows)
    by_width = defaultdict(list)
    for n, c in enumerate(centroids):
        by_width[len(c)].append(n)
    away = np.empty((len(rows), len(centroids)), object if max([rows.shape[1], *by_width]) > _LONG_PLANES else np.int64)
    for numbers in by_width.values():
        c = np.stack([centroids[n] for n in numbers])
        away[:, numbers] = norms[:, None] - 2 * dots(rows, c) + _norms(c)[None, :]
    best = np.argmin(away, axis=1) if away.dtype != object else np.array([min(range(len(x)), key=lambda n: (x[n], n)) for x in away], np.int64)
    distance = away[np.arange(len(rows)), best]
    return best.astype(np.int64), distance


def _steps(batch: pa.RecordBatch, name: str = "planes") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, planes) of a batch's vectors, a bounded number of vectors of one width at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    flat, at = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    widths = np.diff(at)
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        for first in range(0, len(rows), _STEP):
            some = rows[first : first + _STEP]
            yield some, flat[at[some][:, None] + np.arange(w)]


def packed(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, planes) of the usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            block = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), WORD)
            lists = pack(block, scale)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in lists]))).astype(np.int32)
            flat = np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["vec_id", "planes"])

    narrow = vectors.where(usable(F.col(vec_col))).select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"))
    return narrow.mapInArrow(run, "vec_id bigint, planes array<bigint>")


def _assigned(rows: DataFrame, centroids: list[np.ndarray]) -> DataFrame:
    """vec_id, cluster, distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for some, planes in _steps(batch):
                cluster[some], away = nearest(planes, centroids)
                distance[some] = away if away.dtype != object else [min(int(x), _MOST) for x in away]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _bit_counts(rows: DataFrame, centroids: list[np.ndarray]) -> list:
    """Per (cluster, planes of the vector, plane): vectors, and how many have each bit set.  Bounded by the number of clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        size: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            for _, planes in _steps(batch):
                cluster, _ = nearest(planes, centroids)
                bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
                for c in np.unique(cluster).tolist():
                    mine = cluster == c
                    key = (c, planes.shape[1])
                    found[key] = found.get(key, 0) + bits[mine].sum(axis=0, dtype=np.int64)
                    size[key] += int(mine.sum())
        rows_ = [(c, w, j, size[c, w], counts[j]) for (c, w), counts in found.items() for j in range(w)]
        if rows_:
            c, w, j, n, counts = zip(*rows_)
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((c, w, j, n, counts), kinds)], ["cluster", "planes", "plane", "n", "bits"])

    each = rows.mapInArrow(run, "cluster int, planes int, plane int, n bigint, bits array<bigint>")
    sums = [F.sum(F.col("bits")[d]).alias(f"b{d}") for d in range(WORD)]
    return each.groupBy("cluster", "planes", "plane").agg(F.sum("n").alias("n"), *sums).collect()


def _means(counts: list, centroids: list[np.ndarray]) -> list[np.ndarray]:
    """floor(sum / count) per component and cluster; an empty cluster keeps its centroid."""
    sums: dict[int, list[int]] = {}
    size: dict[int, int] = defaultdict(int)
    for r in counts:
        weight = 1 << r["plane"] if r["plane"] < r["planes"] - 1 else -(1 << r["plane"])
        before = sums.get(r["cluster"], [0] * WORD)
        sums[r["cluster"]] = [a + weight * r[f"b{d}"] for d, a in enumerate(before)]
        if r["plane"] == 0:
            size[r["cluster"]] += r["n"]
    out = list(centroids)
    for c, total in sums.items():
        values = [x // size[c] for x in total]
        out[c] = planes_of(np.array([values], object), width(values))[0]
    return out


def cluster(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, seed: int = 2, scale: float = 256.0,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """Exact integer k-means: (vec_id, cluster, distance per usable vector,
    written once; the final centroids).

    The first centroids are the ``clusters`` vectors with the smallest SHA-256
    of ``<seed>:<id>``, in that order (fewer vectors: all of them).  Every
    round assigns all vectors and moves each non-empty centroid to the floor of
    its vectors' mean.  The driver holds the centroids and one table of bit
    counts a round, both bounded by ``clusters``.

    Vectors of another length, null ones and those with null or non-finite
    components take no part.  Repeated rows count each time; among equal ids
    the smaller planes come first as seeds, and null ids come last.  Distances
    beyond a long are cut to its range (comparisons are not).  No usable vector
    gives an empty table and no centroid.  Other columns are not read."""
    ship_package(vectors.sparkSession)
    rows = materialize(packed(vectors, id_col, vec_col, scale))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("planes", draw.alias("draw")).orderBy(F.col("draw").asc_nulls_last(), "planes").limit(clusters).collect()
    centroids = [np.array(r["planes"], np.int64).view(np.uint64) for r in first]
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = _means(_bit_counts(rows, centroids), centroids)
    return materialize(_assigned(rows, centroids)), [unpack(c) for c in centroids]


def cluster_rows(vectors: DataFrame, clusters: int = 40, rounds: int = 5, seed: int = 2, scale: float = 256.0, **columns) -> DataFrame:
    """``cluster`` with each cluster's figures: vec_id, cluster, distance,
    cluster_inertia and inertia (sums of distances, cut to a long's range) and
    centroid_sha256."""
    found, centroids = cluster(vectors, clusters, rounds, seed, scale, **columns)
    spark = vectors.sparkSession
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # one row a cluster
    inertias = {r["cluster"]: int(r["d"]) for r in inertia}
    total = min(sum(inertias.values()), _MOST)
    figures = [
        (n, min(inertias.get(n, 0), _MOST), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(centroids)
    ]
    table = spark.createDataFrame(figures, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(clusters: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """DuckDB: the same clustering, every round a table expression (components and sums stay far below 2^53)."""

    def assign(centroids: str) -> str:
        away = "list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e)"
        return f"""SELECT vec_id, e, cluster, distance FROM (
  SELECT v.vec_id, v.n, v.e, c.cluster, CAST({away} AS BIGINT) AS distance FROM v CROSS JOIN {centroids} c
) x QUALIFY row_number() OVER (PARTITION BY n ORDER BY distance, cluster) = 1"""

    parts = [
        f"""v AS (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS INTEGER) AS cluster, e FROM v QUALIFY cluster < {clusters})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({assign(f'c{r}')})")
        parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
  SELECT cluster, list(mean ORDER BY d) AS e FROM (
    SELECT cluster, d, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS mean FROM (
      SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM a{r}) u GROUP BY cluster, d) g) h GROUP BY cluster) m USING (cluster))""")
    last = f"c{rounds}"
    parts.append(f"a AS MATERIALIZED ({assign(last)})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a JOIN {last} c USING (cluster)"""

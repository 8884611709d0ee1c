"""Centroid clustering with a pivot table: integer vectors, few exact distances.

The distances of every vector to a few fixed pivots are worked out once and kept. By the
triangle inequality the difference of two points' distances to a pivot is at most their own
distance, so in each round the table gives a lower bound for every centroid, and only
centroids whose bound is not over the best distance found so far get an exact one.
Exact distances and centroids are integers throughout; bounds have a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import col, saved

SCALE = 256
#: Integer components are held within this, so that 64 squares of differences fit a long; that is +-524,288 before scaling.
MOST = 1 << 27
#: Pivots, and the vectors they are chosen from (the least by the hash of their id).
PIVOTS, PIVOT_SAMPLE = 16, 1024
#: Share by which a bound is lowered, far over the rounding errors of its square roots.
MARGIN = 1e-9


def hash_order(vec_id: Column, seed: int) -> Column:
    """Lowercase hex SHA-256 of ``seed:id``."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, dims: int) -> DataFrame:
    """(vec_id, v) of the rows with exactly ``dims`` finite components; v holds floor(256 * x) as integers."""
    x = col(df, vector)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(c.cast("double") * SCALE))).cast("int"))
    return df.filter(F.coalesce((F.size(x) == dims) & sound, F.lit(False))).select(col(df, vec_id).alias("vec_id"), scaled.alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one point."""
    apart = vectors.astype(np.int64) - point
    return np.einsum("ij,ij->i", apart, apart)


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots from a sample: the first, then each time the one farthest from those chosen."""
    if not len(sample):
        return sample
    chosen, least = [0], squared(sample, sample[0])
    while len(chosen) < min(count, len(sample)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(np.float64))


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, centroid_table: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (the smaller number on ties), its squared distance, and how many exact distances that took."""
    low = np.zeros((len(vectors), len(centroids)))
    for p in range(table.shape[1]):
        np.maximum(low, np.abs(table[:, p, None] - centroid_table[None, :, p]), out=low)
    slack = MARGIN * (1 + table.max(axis=1, initial=0)[:, None] + centroid_table.max(axis=1, initial=0)[None, :])
    low = np.maximum(low - slack, 0) ** 2 * (1 - MARGIN)
    at, exact = np.arange(len(vectors)), len(vectors)
    cluster = low.argmin(axis=1)
    wide = vectors.astype(np.int64)
    apart = wide - centroids[cluster]
    best = np.einsum("ij,ij->i", apart, apart)
    first = cluster.copy()
    for c in range(len(centroids)):
        left = at[(low[:, c] <= best) & (first != c)]
        if not len(left):
            continue
        exact += len(left)
        d = squared(wide[left], centroids[c])
        closer = (d < best[left]) | ((d == best[left]) & (c < cluster[left]))
        best[left[closer]], cluster[left[closer]] = d[closer], c
    return cluster, best, exact


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dims: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    to_pivots, kind = _to_pivots(centroids, pivots), table.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = nearest(_matrix(batch.column(1), dims), _matrix(batch.column(2), len(pivots)), centroids, to_pivots)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dims: int) -> tuple[np.ndarray, int]:
    """The centroids after one round, and the exact distances it took. A task adds up its vectors; one row a cluster and task shuffles."""
    to_pivots = _to_pivots(centroids, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, exact = np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64), 0
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(1), dims)
                cluster, _, took = nearest(vectors, _matrix(batch.column(2), len(pivots)), centroids, to_pivots)
                np.add.at(total, cluster, vectors)
                count += np.bincount(cluster, minlength=len(centroids))
                exact += took
        sums = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, dims, dtype=np.int32)), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(centroids), dtype=np.int32)), pa.array(count), pa.array(np.full(len(centroids), exact)), sums],
            names=["cluster", "n", "exact", "total"],
        )

    parts = table.mapInArrow(run, "cluster int, n long, exact long, total array<long>").filter("n > 0 OR cluster = 0")
    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    sums = parts.groupBy("cluster").agg(exact("n"), exact("exact"), F.array(*[F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("total"))
    moved, took = centroids.copy(), 0
    for r in sums.collect():  # a row for each centroid
        if r.n:
            moved[r.cluster] = [int(t) // int(r.n) for t in r.total]
        took = int(r.exact) if r.cluster == 0 else took
    return moved, took


def cluster(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, clusters: int = 40, rounds: int = 5, seed: int = 2,
    pivots: int = PIVOTS, pivot_sample: int = PIVOT_SAMPLE,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector kept.

    Kept are vectors of exactly ``dims`` components, none null, NaN or infinite; a component x counts as
    floor(256 * x), at most 2**27 in size. The first centroids are the ``clusters`` vectors with the least
    hash of their id (a null id comes last, equal ids by their components); fewer vectors give fewer
    clusters. A round assigns every vector to the nearest centroid (the smaller number on ties) and
    replaces each centroid by the floor of its vectors' mean; empty ones stay. distance is squared; a sum
    beyond a long is the greatest long.
    Repeated rows are vectors each, also as first centroids. No vectors, no rows.

    Pivots are chosen far apart among the ``pivot_sample`` vectors that have the least hash of their id
    with the next seed: they change the work, never the result. What is shared with tasks
    and what comes back to the driver has ``clusters`` or ``pivots`` rows.
    """
    rows = whole_vectors(df, vec_id, vector, dims)
    order = lambda s: (hash_order(F.col("vec_id"), s).asc_nulls_last(), F.col("v"))
    first = lambda s, n: np.array([r.v for r in rows.orderBy(*order(s)).limit(n).collect()], np.int64).reshape(-1, dims)
    centroids, chosen = first(seed, clusters), far_apart(first(seed + 1, pivot_sample), pivots)
    if not len(centroids):
        return rows.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")
        )
    table = saved(_with_pivots(rows, chosen, dims), "pivot-table")
    for _ in range(rounds):
        centroids, _ = _moved(table, centroids, chosen, dims)
    placed = saved(_assigned(table, centroids, chosen, dims), "clusters")
    sums = {r.cluster: int(r.d) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    long = lambda total: min(total, (1 << 63) - 1)
    known = [
        (c, long(d), long(sum(sums.values())), sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in sorted(sums.items())
    ]
    facts = df.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _with_pivots(rows: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """``rows`` with ``to_pivots``, the distance to each pivot."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = _to_pivots(_matrix(batch.column(1), dims), pivots)
                ends = pa.array(np.arange(0, apart.size + 1, len(pivots), dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(apart.ravel()))], names=["vec_id", "v", "to_pivots"]
                )

    return rows.mapInArrow(run, f"vec_id {kind}, v array<int>, to_pivots array<double>")

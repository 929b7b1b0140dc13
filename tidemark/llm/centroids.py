"""Centroid clustering with Ptolemaic pivots, exact in integers.

For points x, c and pivots p, q Ptolemy's inequality bounds the Euclidean distance from below:

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

Distances from every vector to a few fixed pivots are computed once and stored beside it; a round
needs only those of the centroids.  The centroid of least bound gives an exact first distance, every
centroid whose bound (less all that rounding may have added) exceeds it is passed over, and the
rest are checked exactly in 64-bit integers.  Ties survive the bound, so the smaller number wins.

A round sends one row of sums for each task and cluster to a combining aggregate; only the
centroids reach the driver.  No round keeps an assignment, so a lost executor repeats its share
from the stored vectors alone.

Defined cases: vectors that are null, of another length or hold a null, NaN or infinite component
are left out; a null id sorts after all others when centroids are chosen, equal ids go by
components; repeated rows are separate vectors; fewer vectors than clusters give fewer clusters;
an empty table gives no rows.  Integer components beyond ``LARGEST`` would overflow 64-bit squares
and raise an error.  Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, cut

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
PIVOTS = 6
#: Largest integer component; squared distances of 64 components then fit in 64 bits.
LARGEST = 1 << 27
EPS = np.finfo(np.float64).eps


def integers(vector: Column, scale: int, dimensions: int) -> tuple[Column, Column]:
    """Whether a vector is kept, and its components as integers."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (F.size(vector) == dimensions) & whole, F.transform(vector, lambda v: F.floor(v.cast("double") * scale))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def spread(points: np.ndarray, most: int) -> np.ndarray:
    """Pivots far from each other: each next one maximises its distance to those chosen."""
    chosen = [0] if len(points) else []
    gap = np.full(len(points), np.inf)
    while chosen and len(chosen) < most:
        gap = np.minimum(gap, squared(points, np.broadcast_to(points[chosen[-1]], points.shape)))
        if gap.max() == 0:
            break
        chosen.append(int(gap.argmax()))
    return points[chosen]


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(points, np.broadcast_to(p, points.shape)).astype(np.float64)) for p in pivots], axis=1)


def lower_bounds(own: np.ndarray, of_centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The best Ptolemaic bound of every vector and centroid, never above the true distance."""
    best = np.zeros((len(own), len(of_centroids)))
    between = to_pivots(pivots, pivots)
    for p, q in combinations(range(len(pivots)), 2):
        one, two = own[:, p, None] * of_centroids[None, :, q], own[:, q, None] * of_centroids[None, :, p]
        bound = (np.abs(one - two) - 8 * EPS * (one + two)) / between[p, q]
        np.maximum(best, bound, out=best)
    return best * (1 - 4 * EPS)


def nearest(points: np.ndarray, own: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """Nearest centroid (the first of equals), squared distance, and how many distances were computed."""
    bound = lower_bounds(own, to_pivots(centroids, pivots), pivots)
    guess = bound.argmin(axis=1)
    first = squared(points, centroids[guess])
    open_ = bound * bound * (1 - 8 * EPS) <= first[:, None].astype(np.float64) * (1 + 2 * EPS)
    i, j = np.nonzero(open_)
    table = np.full(bound.shape, np.iinfo(np.int64).max)
    table[i, j] = squared(points[i], centroids[j])
    cluster = table.argmin(axis=1)
    return cluster, table[np.arange(len(points)), cluster], len(points) + len(i)


def _points(column, dimensions: int) -> np.ndarray:
    points = np.asarray(column.flatten()).astype(np.int64).reshape(-1, dimensions)
    if len(points) and max(int(points.max()), -int(points.min())) > LARGEST:
        raise ArithmeticError(f"a component is beyond {LARGEST} after scaling")
    return points


def _assigned(points_df: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dimensions: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            points = _points(batch.column(1), dimensions)
            own = np.asarray(batch.column(2).flatten()).reshape(len(points), -1)
            cluster, distance, _ = nearest(points, own, centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    return points_df.mapInArrow(run, "vec_id long, cluster int, distance long")


def _sums(points_df: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dimensions: int) -> list:
    """Count and component sums of every cluster that is not empty."""
    names = [f"s{k}" for k in range(dimensions)]

    def run(batches):
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dimensions), np.int64)
        for batch in batches:
            points = _points(batch.column(1), dimensions)
            own = np.asarray(batch.column(2).flatten()).reshape(len(points), -1)
            cluster, _, _ = nearest(points, own, centroids, pivots)
            for c in np.unique(cluster):
                mine = points[cluster == c]
                count[c] += len(mine)
                total[c] += mine.sum(axis=0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), *[pa.array(total[some, k]) for k in range(dimensions)]],
                                         ["cluster", "n", *names])

    parts = points_df.mapInArrow(run, "cluster int, n long, " + ", ".join(f"{s} long" for s in names))
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *names)]
    return parts.groupBy("cluster").agg(*whole).collect()  # one row for a cluster


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS,
            scale: int = SCALE, dimensions: int = DIMENSIONS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector."""
    spark = vectors.sparkSession
    usable, ints = integers(F.col(vector_col), scale, dimensions)
    kept = bounded_batches(vectors).filter(usable).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("point"))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(draw.asc_nulls_last(), "point").limit(clusters).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r.point for r in first], np.int64)
    fixed = spread(centroids, pivots)

    def describe(batches):
        for batch in batches:
            points = _points(batch.column(1), dimensions)
            own = to_pivots(points, fixed)
            ends = np.arange(len(points) + 1, dtype=np.int32) * own.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(own.ravel()))], ["vec_id", "point", "own"])

    points = cut(kept.mapInArrow(describe, "vec_id long, point array<long>, own array<double>"))
    for _ in range(rounds):
        centroids = centroids.copy()
        for r in _sums(points, centroids, fixed, dimensions):
            centroids[r.cluster] = [int(s) // int(r.n) for s in r[2:]]
    found = cut(_assigned(points, centroids, fixed, dimensions))
    inertia = {r.cluster: int(r.total) for r in
               found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, t, sum(inertia.values()), digests[c]) for c, t in inertia.items()],
                                  "of_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), F.col("cluster") == F.col("of_cluster")).drop("of_cluster")  # a row for a cluster

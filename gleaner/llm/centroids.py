"""Clustering of integer vectors around centroids, which an n-simplex projection rules out before they are compared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.stage import staged

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = "1"
PIVOTS = 8
# Scaled components up to here: squared distances in 64 dimensions stay within 63 bits.
LARGEST = 1 << 27
# Rounding of apex coordinates, relative to squared distances from the first pivot.
SLACK = 1e-5
# A pivot must stand out from the simplex before it by this share of the highest squared altitude.
LEAST_ALTITUDE = 1 / 64
CHUNK_ROWS = 4096


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` with ``v = floor(scale * x)`` of the vectors with ``dimensions`` finite components."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    given = F.col("embedding").cast("array<double>")
    usable = F.coalesce((F.size(given) == dimensions) & F.forall(given, finite), F.lit(False))
    scaled = F.transform(given, lambda x: F.floor(F.when(F.abs(scale * x) < LARGEST, scale * x)).cast("int"))
    checked = F.when(F.exists(scaled, lambda x: x.isNull()), F.raise_error(F.lit(
        f"components of {LARGEST // scale} or more have squared distances beyond a long"
    )).cast("array<int>")).otherwise(scaled)
    return vectors.filter(usable).select("vec_id", checked.alias("v"))


class Simplex:
    """The apex of any vector above the simplex of the pivots, from its distances to them.

    The first coordinates lie in the pivots' space; the last is the altitude above it, which is not
    negative. Two vectors are at least as far apart as their apexes, and at most as far as if one
    stood on the other side.
    """

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        """Pivots among ``points``: the first, then always the one highest above the simplex so far."""
        moved = (points - points[0]).astype(np.float64)
        left, chosen = moved.copy(), [0]
        height = (left**2).sum(axis=1)
        least = LEAST_ALTITUDE * height.max()
        while len(chosen) < min(most, len(points)) and height.max() > max(least, 0):
            top = int(height.argmax())
            chosen.append(top)
            axis = left[top] / np.sqrt(height[top])
            left -= np.outer(left @ axis, axis)
            height = (left**2).sum(axis=1)
            height[chosen] = 0
        self.pivots = points[chosen]
        base = moved[chosen[1:]]
        self.lengths = (base**2).sum(axis=1)
        self.inverse = np.linalg.inv(np.linalg.cholesky(base @ base.T)) if len(base) else np.empty((0, 0))

    def apexes(self, points: np.ndarray) -> np.ndarray:
        squared = squared_distances(points, self.pivots).astype(np.float64)
        inner = (squared[:, :1] + self.lengths[None, :] - squared[:, 1:]) / 2 @ self.inverse.T
        altitude = np.sqrt(np.maximum(squared[:, 0] - (inner**2).sum(axis=1), 0))
        return np.concatenate([inner, altitude[:, None]], axis=1)


def squared_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to a few others."""
    out = np.empty((len(points), len(others)), np.int64)
    for k, other in enumerate(others):
        out[:, k] = ((points - other) ** 2).sum(axis=1)
    return out


def assigned(
    points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each point: its nearest centroid (ties: the first), its squared distance, and how many were compared."""
    x2, c2 = (apexes**2).sum(axis=1), (tops**2).sum(axis=1)
    size = x2[:, None] + c2[None, :]
    low = size - 2 * apexes @ tops.T
    high = low + 4 * np.outer(apexes[:, -1], tops[:, -1])
    slack = SLACK * size + SLACK
    possible = low - slack <= (high + slack).min(axis=1)[:, None]
    rows, columns = np.nonzero(possible)
    distances = ((points[rows] - centroids[columns]) ** 2).sum(axis=1)
    compared = possible.sum(axis=1)
    starts = np.cumsum(compared) - compared
    least = np.minimum.reduceat(distances, starts)
    hits = np.flatnonzero(distances == least[rows])
    _, first = np.unique(rows[hits], return_index=True)
    return columns[hits[first]], least, compared


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            yield batch.slice(at, CHUNK_ROWS)


def initial_centroids(points: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> np.ndarray:
    """The vectors whose ``seed:vec_id`` has the smallest SHA-256; those without an id last, then by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = points.select(digest.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters)
    return np.array([row["v"] for row in first.collect()], np.int64)


def clustered(
    vectors: DataFrame,
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """``vec_id, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Vectors (``vec_id, embedding``) that are null, of another length, or with null or non-finite components
    are left out. Each row counts, also where ids repeat or are null. With fewer rows than ``clusters``
    there are as many centroids as rows; without rows the result is empty. ``compared`` counts the
    centroids whose exact distance was computed. Components of 2^27 or more after scaling are an error.

    Distances to the pivots are computed once and kept, as apexes, with the vectors. A round reads these;
    each task returns one sum per cluster and dimension, so nothing is shuffled but sums.
    """
    spark = vectors.sparkSession
    points = integer_vectors(vectors, dimensions, scale)
    points = staged(points, "points")
    centroids = initial_centroids(points, clusters, seed)
    if not len(centroids):
        return points.select(
            "vec_id", *(F.lit(0).cast(t).alias(n) for n, t in _COLUMNS), F.lit("").alias("centroid_sha256")
        )
    simplex = Simplex(centroids, pivots)
    width = len(simplex.pivots)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            apexes = simplex.apexes(_matrix(batch.column("v"), dimensions).astype(np.int64))
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(0, len(apexes) * width + 1, width), pa.int32()), pa.array(apexes.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), listed], names=["vec_id", "v", "apex"]
            )

    empty = F.array().cast("array<double>").alias("apex")
    points = staged(points.mapInArrow(project, points.select("vec_id", "v", empty).schema), "apexes")

    def nearest(batch: pa.RecordBatch, current: np.ndarray, tops: np.ndarray):
        given = _matrix(batch.column("v"), dimensions).astype(np.int64)
        return given, *assigned(given, _matrix(batch.column("apex"), width), current, tops)

    for _ in range(rounds):
        centroids = _moved(points, centroids, simplex, nearest)
    tops = simplex.apexes(centroids)

    def final(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            _, cluster, distance, compared = nearest(batch, centroids, tops)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
                    pa.array(compared, pa.int32()),
                ],
                names=["vec_id", "cluster", "distance", "compared"],
            )

    schema = points.select("vec_id", *(F.lit(0).cast(t).alias(n) for n, t in _COLUMNS[:3])).schema
    result = staged(points.mapInArrow(final, schema), "clusters")
    sums = {r["cluster"]: r["s"] for r in result.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    texts = [",".join(map(str, c.tolist())).encode() for c in centroids]
    known = [
        (k, sums.get(k, 0), sum(sums.values()), hashlib.sha256(text).hexdigest()) for k, text in enumerate(texts)
    ]
    about = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return result.join(F.broadcast(about), "cluster").select(
        "vec_id", *(n for n, _ in _COLUMNS), "centroid_sha256"
    )


_COLUMNS = (
    ("cluster", "int"), ("distance", "bigint"), ("compared", "int"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
)


def _moved(points: DataFrame, centroids: np.ndarray, simplex: Simplex, nearest) -> np.ndarray:
    """The centroids after one round: the floor of the exact mean of their vectors; empty ones stay."""
    tops = simplex.apexes(centroids)
    count, dimensions = centroids.shape

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, dimensions), np.int64), np.zeros(count, np.int64)
        for batch in _chunks(batches):
            given, cluster, _, _ = nearest(batch, centroids, tops)
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(given[order], starts, axis=0)
            sizes += np.bincount(cluster, minlength=count)
        found = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(found, dimensions), pa.int32()),
                pa.array(np.tile(np.arange(dimensions), len(found)), pa.int32()),
                pa.array(sums[found].ravel(), pa.int64()),
                pa.array(np.repeat(sizes[found], dimensions), pa.int64()),
            ],
            names=["cluster", "dimension", "total", "n"],
        )

    sums = points.select("v", "apex").mapInArrow(add_up, "cluster int, dimension int, total long, n long")
    moved = centroids.copy()
    for row in sums.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        moved[row["cluster"], row["dimension"]] = row["total"] // row["n"]
    return moved

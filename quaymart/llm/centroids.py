"""Integer k-means whose nearest-centroid search is filtered in a PCA-rotated space.

Vectors are turned into integers, and for each the leading coordinates along the principal
axes and the norm of what these leave out are stored next to them. For a vector x and a
centroid c, the squared distance of the stored coordinates plus the squared difference of the
two residual norms is a lower bound of the squared distance. The centroid with the smallest
bound is measured first; only centroids whose bound is not above that distance are measured
too, in integers. Bounds are doubles and allowed an error far above their rounding, so the
result is that of comparing every vector with every centroid.

A round reads the stored table once, and each task sends one row per cluster. Only centroids,
axes and such sums reach the driver; their number is that of the clusters and components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cut import cut, release

COMPONENTS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LEADING = 8
SEED = "1:"
# Integer components are cut off here, so that a squared distance fits a long.
LARGEST = 1 << 27
_LONGEST = (1 << 63) - 1
_ROWS = 8192
_SLACK = 1e-12  # of the squares that enter a bound


def usable(embedding: str, components: int = COMPONENTS) -> Column:
    """Whether a vector has the right length and only finite components."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(embedding) == components) & F.forall(embedding, finite), F.lit(False))


def integers(embedding: str, scale: int = SCALE) -> Column:
    """floor(scale · x) of every component, within ±``LARGEST``."""
    def one(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    return F.transform(embedding, one)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long integer lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _moments(width: int):
    """Per task, the sums of components and of their products, a row for each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            x = _matrix(batch.column("ints"), width).astype(np.float64)
            total[:, :width] += x.T @ x
            total[:, width] += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total.tolist())], ["i", "sums"])
    return run


def principal_axes(vectors: DataFrame, width: int, leading: int) -> np.ndarray:
    """Orthonormal rows: the ``leading`` axes of largest variance over all vectors."""
    partial = vectors.select("ints").mapInArrow(_moments(width), "i int, sums array<double>")
    sums = partial.groupBy("i").agg(F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width + 1)]).alias("s"))
    rows = sorted(sums.collect())  # one for each component
    count = vectors.count()
    if not rows or not count:
        return np.eye(width)[:leading]
    moments = np.array([r["s"] for r in rows])
    mean = moments[:, width] / count
    _, axes = np.linalg.eigh(moments[:, :width] / count - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1].T[:leading])


def _rotated(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and norm of the rest."""
    x = x.astype(np.float64)
    lead = x @ axes.T
    return lead, np.sqrt(np.maximum((x * x).sum(axis=1) - (lead * lead).sum(axis=1), 0.0))


def _stored(width: int, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = _rotated(_matrix(batch.column("ints"), width), axes)
            lists = pa.ListArray.from_arrays(np.arange(len(lead) + 1, dtype=np.int32) * len(axes), pa.array(lead.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("ints"), lists, pa.array(rest)], ["vec_id", "ints", "lead", "rest"])
    return run


def nearest(
    x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, axes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) per row of ``x``, and how many distances were measured."""
    c_lead, c_rest = _rotated(centroids, axes)
    bound = np.zeros((len(x), len(centroids)))
    for i in range(len(axes)):
        bound += np.square(lead[:, i, None] - c_lead[None, :, i])
    gap = np.abs(rest[:, None] - c_rest[None, :])
    bound += gap * gap
    # Rounding: squares are off by far less than 1e-12 of the whole, the root of a difference by the root of that.
    whole = (np.square(lead).sum(axis=1) + rest * rest)[:, None] + (np.square(c_lead).sum(axis=1) + c_rest * c_rest)
    error = np.sqrt(_SLACK * whole)
    bound -= error * (2 * gap + error) + _SLACK * whole
    first = bound.argmin(axis=1)
    x, centroids = x.astype(np.int64), centroids.astype(np.int64)
    best, number = np.square(x - centroids[first]).sum(axis=1), first.copy()
    measured = len(x)
    for j in range(len(centroids)):
        rows = np.flatnonzero((bound[:, j] <= best) & (first != j))
        if len(rows):
            measured += len(rows)
            distance = np.square(x[rows] - centroids[j]).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (j < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], j
    return number, best, measured


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, axes: np.ndarray):
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        x = _matrix(part.column("ints"), centroids.shape[1])
        lead = _matrix(part.column("lead"), len(axes))
        number, distance, _ = nearest(x, lead, part.column("rest").to_numpy(), centroids, axes)
        yield part, x, number, distance


def _sums(centroids: np.ndarray, axes: np.ndarray):
    """Per task, the number of vectors and their sum for every cluster that it met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            for _, x, number, _ in _assigned(batch, centroids, axes):
                counts += np.bincount(number, minlength=len(counts))
                for j in np.unique(number).tolist():
                    totals[j] += x[number == j].sum(axis=0, dtype=np.int64)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(counts[met]), pa.array(totals[met].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])
    return run


def _labels(centroids: np.ndarray, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, number, distance in _assigned(batch, centroids, axes):
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])
    return run


def moved(vectors: DataFrame, centroids: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The centroids after one round; an empty cluster keeps its own."""
    width = centroids.shape[1]
    partial = vectors.mapInArrow(_sums(centroids, axes), "cluster int, n bigint, sums array<bigint>")
    sums = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums"))
    after = centroids.copy()
    for cluster, n, totals in sums.collect():  # one row for each cluster
        after[cluster] = [total // n for total in totals]
    return after


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    embeddings: DataFrame, *, components: int = COMPONENTS, scale: int = SCALE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, leading: int = LEADING, seed: str = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    A vector is usable if it has exactly ``components`` components, none null or non-finite.
    Centroids start as the vectors with the smallest SHA-256 of ``seed`` and vec_id (equal
    ids: the smaller vector first; a row without vec_id is clustered but starts none), fewer
    if there are not enough; without any the result is empty. Repeated rows count each time.
    Components beyond ±``LARGEST`` after scaling are cut off there, and sums of distances
    beyond a long at its end. Only ``vec_id`` and ``embedding`` are read.
    """
    kept = cut(embeddings.where(usable("embedding", components)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), integers("embedding", scale).alias("ints")))
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = kept.where("vec_id IS NOT NULL").orderBy(order, "ints").limit(clusters).select("ints").collect()
    if not starts:
        release(kept)
        return kept.sparkSession.createDataFrame([], RESULT)
    axes = principal_axes(kept, components, min(leading, components))
    vectors = cut(kept.mapInArrow(
        _stored(components, axes), "vec_id bigint, ints array<int>, lead array<double>, rest double"))
    release(kept)
    centroids = np.array([r["ints"] for r in starts], dtype=np.int64)
    for _ in range(rounds):
        centroids = moved(vectors, centroids, axes)
    labelled = cut(vectors.mapInArrow(_labels(centroids, axes), "vec_id bigint, cluster int, distance bigint"))
    release(vectors)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    per_cluster = {r["cluster"]: int(r["s"]) for r in labelled.groupBy("cluster").agg(exact.alias("s")).collect()}
    total = min(sum(per_cluster.values()), _LONGEST)
    # One row for each cluster.
    known = kept.sparkSession.createDataFrame(
        [(j, min(s, _LONGEST), total, centroid_hash(centroids[j])) for j, s in sorted(per_cluster.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return labelled.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
          "centroid_sha256 string")

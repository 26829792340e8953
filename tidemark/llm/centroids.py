"""Centroid clustering of integer vectors by scalar lookup tables; exact in every number.

Components become integers first. In a round, a slice of vectors gets a table per dimension: the squared difference of
each integer that occurs there to each centroid. The distances of the slice are then sums of rows taken from these tables.
A slice has at most ``SLICE_CELLS`` components and distances, so a table never has more rows than a slice has vectors.

Vectors are written once, as integers, and are never shuffled. Each task sums its own clusters; what moves is a row
per task and cluster, and what passes the driver is the centroids, k times the dimensions.

Defined cases: a vector that is null, has another length, or holds a null or a value that is not finite is left out. An
integer beyond 2^27 (for 64 dimensions) is taken as 2^27, so that distances stay in 64 bits; sums beyond 64 bits are
reported as the largest long. Repeated rows are vectors like any other; a null id is none of the starting centroids and
is assigned like the rest. Starting centroids with equal ids are ordered by their components. With fewer vectors than
centroids there are as many centroids as vectors with an id; with none at all the assignments are null. An empty table
gives an empty result. Ties go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: Components, and distances, of the vectors handled at once.
SLICE_CELLS = 1 << 18
_LONGEST = (1 << 63) - 1


def limit_of(dims: int) -> int:
    """Largest integer of a component, so that a squared distance fits 62 bits."""
    return 1 << (60 - (dims - 1).bit_length()) // 2


def integers(vector: Column, dims: int, scale: float) -> Column:
    """``floor(scale * x)`` of each component in doubles; null for a vector that is not kept."""
    x, most = vector.cast("array<double>"), float(limit_of(dims))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * F.lit(float(scale))))).cast("int"))
    return F.when((F.size(x) == dims) & finite, whole)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance to it, of integer vectors (n, dims)."""
    total = np.zeros((len(points), len(centroids)), np.int64)
    for d in range(points.shape[1]):
        occurring, code = np.unique(points[:, d], return_inverse=True)
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        total += table[code]
    label = total.argmin(axis=1)
    return label, total[np.arange(len(points)), label]


def _slices(batch: pa.RecordBatch, dims: int, k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, SLICE_CELLS // max(dims, k))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each cluster; an empty one stays."""
    k, dims = centroids.shape
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, points in _slices(batch, dims, k):
                label, _ = nearest(points, shared.value)
                n += np.bincount(label, minlength=k)
                np.add.at(total, label, points)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(n[own]), pa.array(list(total[own]), pa.list_(pa.int64()))], names=["cluster", "n", "total"]
        )

    parts = kept.select("v").mapInArrow(sums, "cluster int, n long, total array<long>")
    cells = parts.select("cluster", "n", F.posexplode("total").alias("d", "x")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    )
    after = centroids.copy()
    for row in cells.collect():
        after[row.cluster, row.d] = int(row.x) // row.n
    shared.destroy()
    return after


def _assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of each vector."""
    k, dims = centroids.shape
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, points in _slices(batch, dims, k):
                label, distance = nearest(points, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(label, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"]
                )

    return kept.mapInArrow(assign, f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance long")


def starting(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest SHA-256 (of seed, colon, id) as the first centroids."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.where("id IS NOT NULL").select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster(
    vectors: DataFrame, scratch: str, k: int, rounds: int, dims: int, id: str = "id", vector: str = "embedding",
    scale: float = 256, seed: str = "2",
) -> tuple[DataFrame, np.ndarray]:
    """Assignments ``id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, and the final centroids.

    ``rounds`` times every vector goes to the nearest centroid and every centroid to the floor of its vectors' mean;
    then the vectors are assigned once more.
    """
    spark = vectors.sparkSession
    found = vectors.select(F.col(id).alias("id"), integers(F.col(vector), dims, scale).alias("v")).where("v IS NOT NULL")
    kept = materialise(found, f"{scratch}/vectors")
    centroids = starting(kept, k, seed)
    columns = ("cluster int", "distance long", "cluster_inertia long", "inertia long", "centroid_sha256 string")
    if not len(centroids):
        return kept.select("id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns]), centroids
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    assigned = materialise(_assigned(kept, centroids), f"{scratch}/assigned")
    own = {r.cluster: int(r.x) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    model = [
        (i, min(own.get(i, 0), _LONGEST), min(sum(own.values()), _LONGEST), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    # A row for each centroid.
    about = spark.createDataFrame(model, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("id", *[c.split()[0] for c in columns]), centroids

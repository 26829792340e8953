"""Exact nearest points under the metric of a collection.

The queries are a table of a checked size. Blocks of them are broadcast; every task compares its points with a block and keeps the
best ``k`` per query, so what is exchanged is at most queries times k rows a task, whatever the number of points.
A filter on the payload belongs before: rows that it drops are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.options import check_positive, normalise_metric

#: Numbers in the vectors of the queries that are broadcast at once (32 MB), and distances worked out at once.
BLOCK_CELLS, SLICE_CELLS = 1 << 22, 1 << 20


def distances(queries: np.ndarray, points: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each query to each point in doubles, smaller is nearer: 1 - cosine, minus the dot product, or Euclidean."""
    if metric == "Euclid":
        out = np.empty((len(queries), len(points)))
        for i, q in enumerate(queries):
            out[i] = np.sqrt(((points - q) ** 2).sum(axis=1))
        return out
    dot = queries @ points.T
    if metric == "Dot":
        return -dot
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(points, axis=1)[None, :]
    # A vector of zeros has no direction: cosine 0.
    return 1 - np.divide(dot, norms, out=np.zeros_like(dot), where=norms > 0)


def nearest(
    points: DataFrame, queries: DataFrame, k: int, metric: str = "Cosine", id: str = "id", vector: str = "vector", skip_same: bool = False,
) -> DataFrame:
    """``query, id, distance, rank`` of the ``k`` nearest points of each query; ties go to the smaller id.

    Both frames have ``id`` and ``vector``. Points and queries without a vector, or of another
    length than the first query, are left out. ``skip_same`` leaves out the point with the query's own id.
    """
    check_positive("k", k)
    metric = normalise_metric(metric)
    usable = queries.where(F.col(vector).isNotNull() & F.col(id).isNotNull()).select(F.col(id).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    first = usable.select(F.size("v").alias("n")).first()
    spark, kind = points.sparkSession, points.schema[id].dataType.simpleString()
    schema = f"query {kind}, id {kind}, distance double"
    if first is None:
        return spark.createDataFrame([], f"{schema}, rank int")
    dim = first.n
    usable = usable.where(F.size("v") == dim)
    blocks = max(1, -(-usable.count() * dim // BLOCK_CELLS))
    rows = points.where((F.size(vector) == dim) & F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    found = None
    for b in range(blocks):
        part = usable.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).orderBy("query").collect()
        if not part:
            continue
        shared = spark.sparkContext.broadcast(([r.query for r in part], np.array([r.v for r in part], np.float64)))
        best = rows.mapInArrow(_best(shared, k, metric, dim, skip_same), schema)
        found = best if found is None else found.unionByName(best)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _best(shared, k: int, metric: str, dim: int, skip_same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = shared.value
        held: list[list[tuple]] = [[] for _ in names]
        step = max(1, SLICE_CELLS // max(len(names), dim))
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column("id").to_pylist()
                matrix = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                table = distances(queries, matrix, metric)
                few = min(k + skip_same, len(ids)) - 1
                # All that are no farther than the k-th, ties included.
                bound = np.partition(table, few, axis=1)[:, few]
                for i, own in enumerate(held):
                    near = np.flatnonzero(table[i] <= bound[i]).tolist()
                    own.extend((float(table[i, j]), ids[j]) for j in near if not (skip_same and ids[j] == names[i]))
                    if len(own) > 4 * k:
                        own.sort()
                        del own[k:]
        rows = [{"query": names[i], "id": x, "distance": d} for i, own in enumerate(held) for d, x in sorted(own)[:k]]
        for start in range(0, len(rows), 10_000):
            some = rows[start : start + 10_000]
            columns = [pa.array([r[c] for r in some], t) for c, t in (("query", kind), ("id", kind), ("distance", pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "id", "distance"])

    return run

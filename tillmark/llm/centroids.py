"""Centroid clustering over an incremental distance matrix.

Vectors become integers, so every number below is exact. For each vector the table of a round holds
its squared norm and its dot product with every centroid. The squared distance to a centroid is
norm - 2 * dot + the centroid's own norm, so assigning needs no further product. When centroids move,
the dot products change by the vector's inner product with the change alone: a round multiplies just
the components in which a centroid did change, and a centroid that stayed costs nothing.

Each round reads its table once for the clusters' sums, which are partial per task, and once to write
the next table; the one before is dropped. What meets on the driver is the centroids and their sums,
`k` times the width of a vector. Written rounds outlive the executors that wrote them.

Defined cases: vectors that are null, of another width, or that hold null or non-finite components
take no part. Each row is a vector of its own, repeated ids included; a null id is kept, but can't
seed. Of rows with equal ids the smaller vector seeds first. With fewer than `k` rows that can seed
there are as many centroids, with none there are no rows at all. Equal distances go to the smaller
centroid. A component beyond 2**27 after scaling is an error, as distances would leave 64 bits.
Other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.store import Store

LARGEST = 1 << 27
STEP = 1 << 14  # vectors held at once
STATE = "id long, vector array<long>, norm long, dots array<long>"
SUMS = "cluster int, rows long, sums array<long>"
ASSIGNED = "id long, cluster int, distance long"


def whole(vector: Column, width: int) -> Column:
    """Whether a vector takes part."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce((F.size(vector) == width) & F.forall(vector, finite), F.lit(False))


def matrix(column: pa.Array, kind: pa.DataType, width: int) -> np.ndarray:
    flat = column.flatten().cast(kind).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def product(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact integer product; by floats, which are faster, as far as these are exact."""
    bound = np.abs(rows).max(initial=0) * np.abs(columns).max(initial=0) * max(1, rows.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64
    return (rows.astype(kind) @ columns.astype(kind)).astype(np.int64)


def changes(before: np.ndarray, after: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(centroid, components that changed, by how much) of the centroids that moved."""
    moved = after - before
    return [(c, np.flatnonzero(d), d[d != 0]) for c, d in enumerate(moved) if d.any()]


def moved_dots(vectors: np.ndarray, dots: np.ndarray, moves) -> np.ndarray:
    """The dot products after centroids moved, from those before."""
    dots = dots.copy()
    for c, components, by in moves:
        dots[:, c] += product(vectors[:, components], by[:, None])[:, 0]
    return dots


def nearest(norms: np.ndarray, dots: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centroid, the smaller one if two are as near, and its squared distance."""
    distance = norms[:, None] - 2 * dots + own[None, :]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(cluster)), cluster]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), STEP):
            yield batch.slice(start, STEP)


def _integers(width: int, scale: int):
    def run(batches):
        for batch in _steps(batches):
            values = np.floor(matrix(batch["vector"], pa.float64(), width) * scale)
            if np.abs(values).max(initial=0) > LARGEST:
                raise ValueError(f"a component beyond {LARGEST} after scaling")
            yield pa.RecordBatch.from_arrays(
                [batch["id"], lists(values.astype(np.int64))], names=["id", "vector"]
            )

    return run


def _first_dots(width: int, centroids: np.ndarray):
    def run(batches):
        for batch in _steps(batches):
            vectors = matrix(batch["vector"], pa.int64(), width)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], pa.array((vectors * vectors).sum(axis=1)),
                 lists(product(vectors, centroids.T))],
                names=["id", "vector", "norm", "dots"],
            )

    return run


def _next_dots(width: int, k: int, moves):
    def run(batches):
        for batch in _steps(batches):
            vectors = matrix(batch["vector"], pa.int64(), width)
            dots = moved_dots(vectors, matrix(batch["dots"], pa.int64(), k), moves)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], batch["norm"], lists(dots)],
                names=["id", "vector", "norm", "dots"],
            )

    return run


def _partial_sums(width: int, k: int, own: np.ndarray):
    """Rows and component sums of each cluster in this task."""

    def run(batches):
        rows, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in _steps(batches):
            vectors = matrix(batch["vector"], pa.int64(), width)
            norms = batch["norm"].to_numpy(zero_copy_only=False)
            cluster, _ = nearest(norms, matrix(batch["dots"], pa.int64(), k), own)
            rows += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += vectors[cluster == c].sum(axis=0)
        there = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(rows[there]), lists(sums[there])],
            names=["cluster", "rows", "sums"],
        )

    return run


def _assigned(k: int, own: np.ndarray):
    def run(batches):
        for batch in _steps(batches):
            norms = batch["norm"].to_numpy(zero_copy_only=False)
            cluster, distance = nearest(norms, matrix(batch["dots"], pa.int64(), k), own)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["id", "cluster", "distance"],
            )

    return run


def norms_of(centroids: np.ndarray) -> np.ndarray:
    return (centroids * centroids).sum(axis=1)


def seeds(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors whose ids hash lowest."""
    hashed = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = kept.filter("id is not null").orderBy(hashed, "vector").limit(k)
    return np.array([r.vector for r in first.select("vector").collect()], np.int64)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid's next place: the floor of its vectors' exact mean; its own, if it has none."""
    k, width = centroids.shape
    partial = state.select("vector", "norm", "dots").mapInArrow(
        _partial_sums(width, k, norms_of(centroids)), SUMS
    )
    # Decimals, since sums over all rows may leave 64 bits.
    total = (
        partial.select("cluster", "rows", F.posexplode("sums").alias("place", "part"))
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total"), F.sum("rows").alias("rows"))
    )
    after = centroids.copy()
    for r in total.collect():  # k times the width of a vector
        after[r.cluster, r.place] = int(r.total) // r.rows
    return after


@dataclass(frozen=True)
class Clustering:
    """Each vector's cluster and squared distance (id, cluster, distance), and the centroids."""

    assigned: DataFrame
    centroids: np.ndarray


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", width: int = 64,
            scale: int = 64, k: int = 16, rounds: int = 3, salt: str = "1:") -> Clustering:
    """k-means over floor(scale * x) in integers, `rounds` times, then a last assignment."""
    spark = vectors.sparkSession
    store = Store(spark, "centroids")
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    kept = store.hold(
        rows.filter(whole(F.col("vector"), width)).mapInArrow(
            _integers(width, scale), "id long, vector array<long>"
        ),
        "kept",
    )
    centroids = seeds(kept, k, salt)
    if not len(centroids):
        return Clustering(spark.createDataFrame([], ASSIGNED), np.empty((0, width), np.int64))
    state = store.hold(kept.mapInArrow(_first_dots(width, centroids), STATE), "round-0")
    store.drop("kept")
    for number in range(1, rounds + 1):
        after = means(state, centroids)
        moves = changes(centroids, after)
        if not moves:
            break  # nothing will move any more
        state = store.hold(
            state.mapInArrow(_next_dots(width, len(centroids), moves), STATE), f"round-{number}"
        )
        store.drop(f"round-{number - 1}")
        centroids = after
    found = state.select("norm", "dots", "id").mapInArrow(
        _assigned(len(centroids), norms_of(centroids)), ASSIGNED
    )
    return Clustering(store.hold(found, "assigned"), centroids)


def described(spark: SparkSession, found: Clustering) -> DataFrame:
    """Per centroid with vectors: cluster, cluster_inertia, inertia, centroid_sha256."""
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    sums = found.assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia")
    )
    inertia = {r.cluster: int(r.inertia) for r in sums.collect()}  # one row per centroid
    whole_sum = sum(inertia.values())

    def code(components: np.ndarray) -> str:
        return hashlib.sha256(",".join(map(str, components.tolist())).encode()).hexdigest()

    return spark.createDataFrame(
        [(c, own, whole_sum, code(found.centroids[c])) for c, own in sorted(inertia.items())], schema
    )


def report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    found = cluster(vectors, **options)
    about = described(vectors.sparkSession, found)  # k rows
    return found.assigned.withColumnRenamed("id", "vec_id").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

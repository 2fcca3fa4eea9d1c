"""Centroid clustering of integer vectors: nearest centroids by a tournament of bisectors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from martlight.session import materialize

CENTROIDS = 40
ROUNDS = 5
DIMENSIONS = 64
# Components become integers by this factor.
SCALE = 256
SEED = 2

# Sums of products below these are exact in doubles and in 64-bit integers.
_DOUBLE, _LONG = 1 << 53, 1 << 62
# Vectors that play a tournament at once: few enough for the normals they look up to stay in cache.
_ROWS = 1024


def usable(vector: Column, dimensions: int | None = None) -> Column:
    """Whether a vector holds finite numbers alone, and ``dimensions`` of them; never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    right_size = F.size(vector) == dimensions if dimensions is not None else F.size(vector) > 0
    return F.coalesce(vector.isNotNull() & right_size & finite, F.lit(False))


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit integers, or Python's where one does not fit in half of them."""
    if np.abs(values).max(initial=0) * scale < 1 << 31:
        return np.floor(values * scale).astype(np.int64)
    # From 2 ** 53 on a double is a whole number itself, and times the scale may leave the doubles.
    whole = [math.floor(x * scale) if abs(x) < 1 << 53 else int(x) * scale for x in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _largest(values: np.ndarray) -> int:
    return int(max(abs(values.max()), abs(values.min()))) if values.size else 0


class Bisectors:
    """The bisector of each pair of centroids as a normal and a threshold, all whole numbers.

    For a < b, x is nearer to b than to a where x . normal exceeds the threshold.
    """

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, dtype=object).reshape(len(centroids), len(centroids[0]) if centroids else 0)
        squares = (c * c).sum(axis=1) if c.size else np.zeros(len(c), dtype=object)
        self.centroids, self.count = c, len(c)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]
        self._width = c.shape[1]
        self._reach = max(_largest(self.normals), 1)
        self._farthest = _largest(self.thresholds)

    def _kind(self, largest: int):
        """A number type in which all sums are exact: doubles, 64-bit integers or Python's own."""
        bound = max(self._width * max(largest, self._reach) * self._reach, self._farthest)
        return np.float64 if bound < _DOUBLE else np.int64 if bound < _LONG else object

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of each vector's nearest centroid; of equally near ones the smallest.

        Centroid 0 meets 1, the winner 2, and so on. One sign tells the nearer; on the bisector itself the
        winner so far, which has the smaller number, stays. The order of distances is total, so
        what loses once can't be nearest.
        """
        kind = self._kind(_largest(vectors))
        x, normals, thresholds = (v.astype(kind) for v in (vectors, self.normals, self.thresholds))
        best = np.zeros(len(x), dtype=np.int64)
        for rows in (slice(at, at + _ROWS) for at in range(0, len(x), _ROWS)):
            some, winner = x[rows], best[rows]
            for rival in range(1, self.count):
                facing = normals[:, rival][winner]
                side = (some * facing).sum(axis=1) if kind is object else np.einsum("ij,ij->i", some, facing)
                winner[side > thresholds[:, rival][winner]] = rival
        return best

    def distances(self, vectors: np.ndarray, nearest: np.ndarray) -> np.ndarray:
        """The exact squared distance of each vector to its own centroid."""
        largest = _largest(vectors) + _largest(self.centroids)
        kind = np.int64 if self._width * largest * largest < _LONG else object
        gap = vectors.astype(kind) - self.centroids.astype(kind)[nearest]
        return (gap * gap).sum(axis=1)


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(len(column), -1), scale)


def _first_centroids(kept: DataFrame, count: int, seed: int) -> list[list[float]]:
    """The vectors of least sha256 of ``<seed>:<id>``, ids in decimal; of one id the least vector first."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "vector").limit(count)
    return [list(r.vector) for r in first.select("vector").collect()]


def _sums(kept: DataFrame, bisectors: Bisectors, scale: int) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of each cluster's vectors.

    Each task sends one row a cluster, with sums in decimal digits, so they are exact whatever their size;
    a cluster's rows, one a task, are added up in one more step, and one row a cluster reaches the driver.
    """
    schema = StructType(
        [
            StructField("cluster", IntegerType()),
            StructField("count", LongType()),
            StructField("sums", ArrayType(StringType())),
        ]
    )

    def rows(counts: dict[int, int], sums: dict[int, list[int]]) -> pa.RecordBatch:
        keys = sorted(counts)
        digits = [[str(v) for v in sums[k]] for k in keys]
        arrays = [pa.array(keys, pa.int32()), pa.array([counts[k] for k in keys], pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(digits, pa.list_(pa.string()))], names=schema.names)

    def add(counts: dict, sums: dict, cluster: int, count: int, more: list[int]) -> None:
        counts[cluster] = counts.get(cluster, 0) + count
        sums[cluster] = [a + b for a, b in zip(sums[cluster], more)] if cluster in sums else more

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            vectors = _matrix(batch.column("vector"), scale)
            nearest = bisectors.nearest(vectors)
            for cluster in np.unique(nearest).tolist():
                own = vectors[nearest == cluster]
                add(counts, sums, cluster, len(own), [int(v) for v in own.sum(axis=0)])
        yield rows(counts, sums)

    def of_cluster(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in tables:
            for row in batch.to_pylist():
                add(counts, sums, row["cluster"], row["count"], [int(v) for v in row["sums"]])
        yield rows(counts, sums)

    partial = kept.select("vector").mapInArrow(of_task, schema)
    total = partial.repartition("cluster").mapInArrow(of_cluster, schema)
    return {r.cluster: (r["count"], [int(v) for v in r.sums]) for r in total.collect()}


def _as_long(value: Column) -> Column:
    """A decimal as a long, null where it does not fit."""
    return value.try_cast("long")


def cluster_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector, and the centroids.

    Kept are vectors of ``dimensions`` components, none null or non-finite. Each component x becomes
    floor(scale * x), and everything after is whole numbers of any size. The centroids start as the kept
    vectors whose key has the least hash (a null key comes last), fewer if there are fewer. Each
    round moves every centroid that has vectors to their componentwise floor of the mean. Equally near
    centroids give way to the one of the smaller number. distance is the squared one; inertia sums it over all,
    cluster_inertia over a cluster; a number that no long can hold is null. centroid_sha256 hashes the
    components of the final centroid, as decimals joined by commas.
    Repeated rows and keys are vectors of their own. No kept vector: no rows, no centroids.

    A round is one pass over the stored vectors; ``count`` rows reach the driver, ``count`` centroids and
    their ``count`` squared normals go to the tasks.
    """
    named = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    kept = materialize(named.where(usable(F.col("vector"), dimensions)), "vectors")
    centroids = [list(map(int, c)) for c in integers(np.array(_first_centroids(kept, count, seed), dtype=np.float64), scale)]
    for _ in range(rounds if centroids else 0):
        for cluster, (members, sums) in _sums(kept, Bisectors(centroids), scale).items():
            centroids[cluster] = [s // members for s in sums]
    bisectors = Bisectors(centroids)
    schema = StructType(
        [
            StructField("id", kept.schema["id"].dataType),
            StructField("cluster", IntegerType()),
            StructField("distance", LongType()),
        ]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _matrix(batch.column("vector"), scale)
            nearest = bisectors.nearest(found)
            distances = [d if d < 1 << 63 else None for d in bisectors.distances(found, nearest).tolist()]
            arrays = [batch.column("id"), pa.array(nearest.astype(np.int32)), pa.array(distances, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    assigned = materialize(kept.mapInArrow(assign, schema), "clusters")
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    # A sum over a distance that is too large itself is too large as well.
    inertia = F.when(F.count(F.lit(1)) == F.count("distance"), whole)
    names = [",".join(map(str, c)) for c in centroids]
    shas = F.array(*[F.lit(hashlib.sha256(n.encode()).hexdigest()) for n in names]).cast("array<string>")
    per_cluster = assigned.groupBy(F.col("cluster").alias("its_cluster")).agg(_as_long(inertia).alias("cluster_inertia"))
    result = assigned.join(F.broadcast(per_cluster), F.col("cluster") == F.col("its_cluster")).select(
        F.col("id").alias(key),
        "cluster",
        "distance",
        "cluster_inertia",
        assigned.agg(_as_long(inertia).alias("inertia")).scalar().alias("inertia"),
        F.get(shas, "cluster").alias("centroid_sha256"),
    )
    return result, centroids

"""Centroid clustering with nearest centroids found by the threshold algorithm.

Vectors become integer points, floor(scale * x) of each component. For each dimension
the centroids' values are sorted once; a point walks every list outward from its own
value, reading one entry of each list a round, the nearer one first. A centroid's exact
squared distance is taken where a list first shows it. A centroid that no list has shown
is in each dimension at least as far as the entry read last, so the walk stops once the
squares of those frontier distances add up to strictly more than the best exact
distance; on equality an unseen centroid with a smaller number might still tie.

Points are written once; each round is a pass over them in which every task sends one
row of exact sums for each centroid, and the new centroids (k * dims integers) are the
only data on the driver. All arithmetic is in integers, so results don't depend on
order or partitions.

Defined results: vectors that are null, of another length, or hold a null or non-finite
component take no part. Repeated rows each take part. Starting centroids are ordered by
hash, then by components; a row without an id is no start. With fewer vectors than
centroids there are as many centroids as vectors; an empty table gives no rows. Ties go
to the smaller number, and an empty cluster keeps its centroid. Integers of 2**27 or
more in size are an error, since squared distances would no longer fit a long; sums of
distances beyond a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvelake.llm.common import ship
from cvelake.session import stage

DIMS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
GREATEST = 1 << 27
#: Points walked at once; sized for the processor's cache.
ROWS = 1024


def points(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, point array<long>) of the rows that take part."""
    real = F.col("embedding").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    kept = vectors.filter((F.size("embedding") == dims) & F.forall(real, fine))
    fits = F.forall(real, lambda x: F.abs(x * scale) < GREATEST - 1)
    whole = F.transform(real, lambda x: F.floor(x * scale))
    return kept.select("vec_id", F.when(fits, whole).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).alias("point"))


class Lists:
    """Sorted lists of the centroids' values by dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.numbers = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.numbers, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, squared distance, rounds walked) of each row's nearest centroid."""
        n, dims = x.shape
        k, every = len(self.centroids), np.arange(dims)
        above = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in every], axis=1)
        below = above - 1
        far = np.iinfo(np.int64).max
        best, number, rounds = np.full(n, far), np.full(n, k), np.zeros(n, np.int64)
        seen = np.zeros((n, k), bool)
        left = np.arange(n)
        for _ in range(k):
            own, low, high = x[left], below[left], above[left]
            gap_low = np.where(low >= 0, own - self.values[np.maximum(low, 0), every], far)
            gap_high = np.where(high < k, self.values[np.minimum(high, k - 1), every] - own, far)
            down = gap_low <= gap_high
            shown = self.numbers[np.where(down, low, high), every]
            below[left], above[left] = low - down, high + ~down
            new = np.zeros((len(left), k), bool)
            new[np.arange(len(left))[:, None], shown] = True
            new &= ~seen[left]
            seen[left] |= new
            row, centroid = np.nonzero(new)
            exact = ((own[row] - self.centroids[centroid]) ** 2).sum(axis=1)
            self._better(best, number, left[row], centroid, exact)
            rounds[left] += 1
            frontier = (np.minimum(gap_low, gap_high) ** 2).sum(axis=1)
            left = left[frontier <= best[left]]
            if not len(left):
                break
        return number, best, rounds

    @staticmethod
    def _better(best: np.ndarray, number: np.ndarray, rows: np.ndarray, centroid: np.ndarray, exact: np.ndarray) -> None:
        """Keeps the least (distance, number) of each row."""
        order = np.lexsort((centroid, exact, rows))
        rows, centroid, exact = rows[order], centroid[order], exact[order]
        lead = np.ones(len(rows), bool)
        lead[1:] = rows[1:] != rows[:-1]
        rows, centroid, exact = rows[lead], centroid[lead], exact[lead]
        wins = (exact < best[rows]) | ((exact == best[rows]) & (centroid < number[rows]))
        best[rows[wins]], number[rows[wins]] = exact[wins], centroid[wins]


def _walk(column: pa.Array, lists: Lists) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    dims = lists.centroids.shape[1]
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for at in range(0, len(x), ROWS):
        own = x[at : at + ROWS]
        number, distance, _ = lists.nearest(own)
        yield own, number, distance


def _sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for x, number, _ in _walk(batch.column("point"), lists):
                np.add.at(sums, number, x)
                counts += np.bincount(number, minlength=len(centroids))
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    return run


def starts(found: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The points with the smallest hashes of seed and id, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = found.filter(F.col("vec_id").isNotNull()).orderBy(key, "point").limit(k).select("point").collect()
    return np.array([r["point"] for r in first], np.int64)


def moved(found: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty cluster's centroid becomes the floor of its points' mean."""
    partial = found.select("point").mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    by_place = partial.select("cluster", "n", F.posexplode("sums").alias("place", "value")).groupBy("cluster", "place").agg(exact("n"), exact("value"))
    out = centroids.copy()
    for r in by_place.collect():
        out[r["cluster"], r["place"]] = int(r["value"]) // int(r["n"])
    return out


def fit(found: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after all rounds over ``found`` (written points), (k, dims)."""
    ship(found.sparkSession)
    centroids = starts(found, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(found, centroids)
    return centroids


def assign(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in batches:
            parts = [(n, d) for _, n, d in _walk(batch.column("point"), lists)]
            number, distance = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return found.mapInArrow(run, f"vec_id {found.schema['vec_id'].dataType.simpleString()}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    vector (vec_id, embedding) that takes part; other columns are left out."""
    found = stage(points(vectors, dims, scale), "centroid_points")
    centroids = fit(found, k, rounds, seed)
    if not len(centroids):
        # No vector with an id takes part, so nothing can start a cluster.
        kind = found.schema["vec_id"].dataType.simpleString()
        return found.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    placed = stage(assign(found, centroids), "centroid_clusters")
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    rows = [(c, fits(s), fits(sum(sums.values())), digest(centroids[c])) for c, s in sorted(sums.items())]
    # One row for each centroid.
    facts = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

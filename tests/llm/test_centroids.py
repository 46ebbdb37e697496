"""Centroid clustering against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from helpers_llm import SF
from pyspark.sql import functions as F

from cvelake.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>"


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain(rows, dims=64, k=8, rounds=10):
    fine = lambda v: v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if fine(v)]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)
    found = [p for _, p in first[:k]]
    place = lambda p: min((distance(p, c), j) for j, c in enumerate(found))
    for _ in range(rounds):
        groups = [[] for _ in found]
        for _, p in kept:
            groups[place(p)[1]].append(p)
        found = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, found, strict=True)]
    placed = [(i, *place(p)) for i, p in kept] if found else []
    inertia = [sum(d for _, d, j in placed if j == c) for c in range(len(found))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    return [(i, j, d, inertia[j], sum(inertia), shas[j]) for i, d, j in placed]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_query_equals_plain_version(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert in_order(queries.op13_threshold_centroids(spark, SF).collect()) == in_order(plain(rows))


def test_rows_that_take_no_part_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(60)]
    rows += [(100, [1.0, 1.0, 1.0, 1.0])] * 30 + [(None, [0.5, 0.5, 0.5, 0.5]), (None, None), (101, None), (102, []), (103, [1.0, 2.0, 3.0])]
    rows += [(104, [1.0, None, 0.0, 0.0]), (105, [float("nan"), 0.0, 0.0, 0.0]), (106, [float("inf"), 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("cluster", "distance", "point", "inertia", "label")})
    found = centroids.cluster(vectors, dims=4)
    assert in_order(found.collect()) == in_order(plain(rows, dims=4))


def test_fewer_vectors_than_centroids_and_none(spark):
    few = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    assert in_order(centroids.cluster(spark.createDataFrame(few, SCHEMA), dims=2).collect()) == in_order(plain(few, dims=2))
    none = centroids.cluster(spark.createDataFrame([], SCHEMA), dims=2)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_components_beyond_exact_distances_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dims=2)


def test_walk_finds_the_nearest_with_the_smallest_number():
    rng = np.random.default_rng(1)
    for dims, k, spread in ((64, 8, 1000), (3, 40, 6), (1, 5, 2), (16, 200, 500)):
        c, x = rng.integers(-spread, spread, (k, dims)), rng.integers(-spread, spread, (500, dims))
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        number, best, _ = centroids.Lists(c).nearest(x)
        assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_walk_stops_early_where_clusters_lie_apart():
    rng = np.random.default_rng(2)
    c = rng.integers(-100_000, 100_000, (50, 8))
    x = c[rng.integers(0, 50, 400)] + rng.integers(-50, 50, (400, 8))
    _, _, rounds = centroids.Lists(c).nearest(x)
    assert rounds.mean() < 5


def test_walk_goes_on_while_an_unseen_centroid_may_tie():
    # Both are at distance 2; the lists show number 1 first, whose frontier then equals it.
    c = np.array([[1, 1], [0, 0]])[:, :1].repeat(2, axis=1)
    number, best, _ = centroids.Lists(np.array([[1, -1], [-1, 1]]) + c * 0).nearest(np.array([[0, 0]]))
    assert number.tolist() == [0] and best.tolist() == [2]

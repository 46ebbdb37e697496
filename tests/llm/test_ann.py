import numpy as np
import pytest
from pyspark.sql import functions as F

from cvelake.llm import ann
from cvelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(ids, x, query_ids, k=10):
    out = {}
    for q in query_ids:
        at = ids.index(q)
        gap = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        order = sorted((gap[i], ids[i]) for i in range(len(ids)) if ids[i] != q)
        out[q] = order[:k]
    return out


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    want = brute(ids, x, [i for i in ids if i % 100 == 0])
    got = {}
    for r in QUERIES["op6_cross_polytope_search"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        for _, score, v in found:
            assert abs(score - np.sqrt(((x[ids.index(v)] - x[ids.index(q)]) ** 2).sum())) < 1e-12
        hits += len({v for _, _, v in found} & {v for _, v in want[q]})
    assert hits >= 0.9 * 10 * len(want)


def test_recall_on_random_vectors_in_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 48))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = ann.search(df, df.filter("vec_id % 100 = 0"), tables=12, block=700).groupBy("query_id").agg(F.collect_set("vec_id")).collect()
    want = brute(list(range(3000)), x.astype(np.float64), range(0, 3000, 100))
    assert sum(len(set(found) & {v for _, v in want[q]}) for q, found in got) >= 0.9 * 300


@pytest.mark.parametrize("lengths", ["unit", "uniform", "lognormal"])
def test_recall_with_production_probes_and_unequal_lengths(spark, lengths):
    """One block, about 80 times as many vectors as a query meets in a table."""
    rng = np.random.default_rng(2)
    n = 10_500
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"unit": np.ones(n), "uniform": rng.uniform(0.5, 2, n), "lognormal": rng.lognormal(0, 0.3, n)}[lengths][:, None]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = ann.search(df, df.filter("vec_id % 350 = 0")).groupBy("query_id").agg(F.collect_set("vec_id")).collect()
    asked = range(0, n, 350)
    want = brute(list(range(n)), x.astype(np.float64), asked)
    assert len(got) == len(asked)
    recall = sum(len(set(found) & {v for _, v in want[q]}) for q, found in got) / (10 * len(asked))
    print(f"recall {lengths} {recall:.3f}")
    assert recall >= 0.9


def test_recall_of_full_blocks(spark):
    """Over 10,000 vectors in each band of each block, for unit lengths and two lengths."""
    rng = np.random.default_rng(6)
    n = 2 * ann.BLOCK
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = ann.search(df, df.filter("vec_id % 800 = 0")).groupBy("query_id").agg(F.collect_set("vec_id")).collect()
    want = brute(list(range(n)), x.astype(np.float64), range(0, n, 800))
    recall = sum(len(set(found) & {v for _, v in want[q]}) for q, found in got) / (10 * len(want))
    print(f"recall full blocks {recall:.3f}")
    assert recall >= 0.9


def test_doubles_keep_their_precision(spark):
    base = [0.1 + 1e-12 * i for i in range(6)]
    rows = [(i, [b, 1.0 / 3.0]) for i, b in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id = 0")).orderBy("rank").collect()
    x = np.array([v for _, v in rows])
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, float(np.sqrt(((x[i] - x[0]) ** 2).sum()))) for i in range(1, 6)]


def test_bands_beyond_the_bound_merge_the_smallest():
    assert ann.bands_of({3: 5, 0: 1, 1: 2, 9: 9}, 4) == [(0, 1), (1, 2), (3, 5), (9, 9)]
    assert ann.bands_of({3: 5, 0: 1, 1: 2, 9: 9}, 2) == [(0, 8), (9, 9)]
    assert ann.bands_of({}) == []


def test_copies_ties_and_vectors_that_take_no_part(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 2.0, 0.0], [0.0, 0.0, -3.0]
    rows = [(i, a) for i in range(40)] + [(100, b), (101, b), (102, c), (102, c)]
    rows += [(200, None), (201, [0.0] * 3), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 0.0]), (204, [float("inf"), 1.0, 0.0]), (205, [1.0]), (None, a)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1)).withColumn("score", F.lit("s"))
    got = {}
    for r in ann.search(df, df.filter("vec_id in (0, 30, 100, 200, 201, 202, 203, 204, 205)")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    ids = [*range(40), 100, 101, 102]
    x = np.array([a] * 40 + [b, b, c])
    assert got == brute(ids, x, [0, 30, 100])
    few = df.filter("vec_id in (5, 100, 102)")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(few, few.filter("vec_id = 100")).orderBy("rank").collect()] == [(100, 1, 5), (100, 2, 102)]
    assert ann.search(df.filter("false"), df.filter("false")).count() == 0


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 20)).astype(np.float32)
    assert np.allclose(np.linalg.norm(ann.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1), rtol=1e-5)
    y = np.array([[0.1, -0.9], [0.8, 0.2]], np.float32)
    assert ann.nearest_axis(y).tolist() == [3, 0]

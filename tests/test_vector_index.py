"""The cell index against the full search, and text vectors against numpy."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cvelake.operators import ivf
from cvelake.operators.vector import BestScores, batch_cosine_topk
from cvelake.plans import search as se


def _rows(df):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 5)) for r in df.collect())


def _frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)


def _grouped(rng, n, dims=24, groups=40):
    centres = rng.normal(size=(groups, dims))
    return centres[rng.integers(0, groups, n)] + 0.25 * rng.normal(size=(n, dims))


def test_exact_form_equals_the_full_search(spark):
    rng = np.random.default_rng(0)
    for x in (_grouped(rng, 1500), rng.normal(size=(800, 16))):
        df = _frame(spark, x)
        q = df.filter("id % 40 = 0").select(F.col("id").alias("qid"), "v")
        found = ivf.search(ivf.build(df, "v", "id"), q, "qid", "v", 7, probes=2, exact=True)
        assert _rows(found) == _rows(batch_cosine_topk(df, "v", "id", q, "qid", "v", 7))


def test_recall_and_work_on_grouped_vectors(spark):
    """Few probes find the neighbours, and the vectors scored stay a small share."""
    x = _grouped(np.random.default_rng(1), 4000)
    df = _frame(spark, x)
    q = df.filter("id % 50 = 0").select(F.col("id").alias("qid"), "v")
    index = ivf.build(df, "v", "id")
    want = {r[:1] + r[2:3] for r in _rows(batch_cosine_topk(df, "v", "id", q, "qid", "v", 10))}
    got = {r[:1] + r[2:3] for r in _rows(ivf.search(index, q, "qid", "v", 10, probes=6))}
    assert len(want & got) / len(want) >= 0.9
    visited = ivf._visits(index, q.select(F.col("qid").alias("query_id"), F.col("v").alias("_query")), 6, None)
    scored = sum(index.sizes.get(r["cell"], 0) for r in visited.select("cell").collect())
    assert scored < 0.25 * 80 * 4000


def test_a_cell_with_a_third_of_all_vectors_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ivf, "CANDIDATE_BLOCK", 100)
    monkeypatch.setattr(ivf, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(2)
    x = np.concatenate([_grouped(rng, 800), np.tile(rng.normal(size=24), (400, 1))])
    df = _frame(spark, x)
    q = df.filter("id % 60 = 0").select(F.col("id").alias("qid"), "v")
    found = ivf.search(ivf.build(df, "v", "id"), q, "qid", "v", 5, exact=True)
    assert _rows(found) == _rows(batch_cosine_topk(df, "v", "id", q, "qid", "v", 5))


def test_vectors_without_a_direction_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    q = df.select(F.col("id").alias("qid"), "v").filter("id in (1, 2, 3)")
    assert _rows(ivf.search(ivf.build(df, "v", "id"), q, "qid", "v", 3, exact=True)) == [(1, 1, 1, 1.0), (1, 2, 5, 0.70711)]
    none = df.filter("false")
    assert ivf.search(ivf.build(none, "v", "id"), q, "qid", "v", 3).collect() == []


def _vectors(texts, dims):
    tokens = [Counter(re.findall("[a-z0-9_]+", t.lower())) for t in texts]
    df = Counter(w for t in tokens for w in t)
    idf = {w: math.log((len(texts) + 1) / (n + 1)) for w, n in df.items()}

    def vector(counts):
        out = np.zeros(dims)
        for w, tf in counts.items():
            h = hashlib.md5(w.encode()).hexdigest()
            out[int(h[:8], 16) % dims] += tf * idf.get(w, 0) * (1 if h[8] < "8" else -1)
        norm = np.linalg.norm(out)
        return out / norm if norm else None

    return vector, [vector(t) for t in tokens]


@pytest.mark.parametrize("dims", [8, 256])
def test_text_vectors_are_hashed_weights(spark, dims):
    texts = ["the quick brown fox", "the the lazy dog_7", "", "the", "quick quick DOG", "a b c d e f g h i j k l"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    vectors, idf = se.document_vectors(docs, "id", "t", dims)
    one, want = _vectors(texts, dims)
    got = {r["id"]: r["embedding"] for r in vectors.collect()}
    assert set(got) == {i for i, v in enumerate(want) if v is not None}
    for i, v in got.items():
        assert np.allclose(v, want[i])
    asked = spark.createDataFrame([(7, "lazy fox fox unknown"), (8, "unknown"), (9, None)], "id long, t string")
    found = {r["id"]: r["embedding"] for r in se.query_vectors(asked, "id", "t", idf, dims).collect()}
    assert set(found) == {7} and np.allclose(found[7], one(Counter({"lazy": 1, "fox": 2})))


def test_a_search_by_text_is_the_same_over_the_index(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    docs = [(f"C{i:03d}", " ".join(rng.choice(words[10 * (i % 20):], 30)), None, None, 0.5, False, None, None, None) for i in range(400)]
    schema = "cve_id string, document_text string, cvss_v3_score double, cvss_v3_severity string, epss_score double, kev_flag boolean, vendors_str string, products_str string, cwe_id string"
    documents = spark.createDataFrame(docs, schema)
    enriched = documents.select("cve_id", F.col("document_text").alias("description"), F.lit("LOW").alias("risk_tier"), "kev_flag", "cvss_v3_score")
    asked = spark.createDataFrame([(i, docs[i * 7][1][:40]) for i in range(20)], "q long, t string")
    full, indexed = (sorted(map(tuple, se.semantic_text_search(documents, enriched, asked, "q", "t", 4, indexed=x).collect())) for x in (False, True))
    assert full == indexed and len(full) == 80


def test_a_query_is_sent_once_for_the_cells_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(ivf, "CANDIDATE_BLOCK", 300)
    monkeypatch.setattr(ivf, "ASKED_BLOCK", 16)
    x = np.random.default_rng(6).normal(size=(900, 16))
    df = _frame(spark, x)
    index = ivf.build(df, "v", "id")
    q = df.filter("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("_query"))
    sent = ivf._sent(index, q, len(index.centres), None).collect()
    groups = {g for g, _ in ivf._groups(index).values()}
    assert len(groups) < len(index.sizes) / 5 and len(sent) == 45 * len(groups)
    assert sorted(c for r in sent if r["query_id"] == 20 for c in r["cells"]) == sorted(index.sizes)
    asked = q.select(F.col("query_id").alias("qid"), F.col("_query").alias("v"))
    found = ivf.search(index, asked, "qid", "v", 5, exact=True)
    assert _rows(found) == _rows(batch_cosine_topk(df, "v", "id", asked, "qid", "v", 5))


def test_copies_of_a_vector_are_no_row_for_each_pair(spark):
    """One vector 300 times, asked 300 times: a block gives a query its k best, by id
    (a tie from another cell may come along)."""
    rng = np.random.default_rng(7)
    x = np.concatenate([np.tile(rng.normal(size=16), (300, 1)), rng.normal(size=(200, 16))])
    df = _frame(spark, x)
    index = ivf.build(df, "v", "id")
    q = df.select(F.col("id").alias("query_id"), F.col("v").alias("_query"))
    rows = ivf._scores(index, ivf._sent(index, q, len(index.centres), None), 4)
    assert {g for g, _ in ivf._groups(index).values()} == {0} and rows.count() <= 2 * 500 * 4
    asked = df.select(F.col("id").alias("qid"), "v")
    assert _rows(ivf.search(index, asked, "qid", "v", 4, exact=True)) == _rows(batch_cosine_topk(df, "v", "id", asked, "qid", "v", 4))


def test_blocks_grow_with_the_table_up_to_a_bound():
    sizes = [ivf._block(ivf.CANDIDATE_BLOCK, n, 64) for n in (0, 50_000, 500_000, 10**9)]
    assert sizes == [ivf.LEAST_BLOCK, ivf.LEAST_BLOCK, -(-500_000 // ivf.DEALT), ivf.CANDIDATE_BLOCK]
    assert ivf._block(ivf.CANDIDATE_BLOCK, 10**9, 1536) * 1536 <= ivf.BLOCK_FLOATS


def test_only_scores_that_may_be_hits_are_taken():
    rng = np.random.default_rng(9)
    scores = np.round(rng.random((40, 90)), 1)  # many ties
    scores[:, ::3] = rng.random((40, 30))
    known = np.where(np.arange(40) % 4 == 0, 0.7, -np.inf)
    best, rows = BestScores(40, 5, known), np.arange(40)
    got = []
    for low in range(0, 90, 30):
        r, c = best.take(scores[:, low : low + 30], rows)
        assert np.bincount(r, minlength=40).max() <= 5
        got += list(zip(r, c + low, strict=True))
    kept = best.still(np.array([r for r, _ in got]), np.array([scores[x] for x in got]))
    for i in rows:
        want = sorted((-scores[i, c], c) for c in range(90) if scores[i, c] >= known[i])[:5]
        assert sorted((-scores[x], x[1]) for x, good in zip(got, kept, strict=True) if good and x[0] == i)[:5] == want

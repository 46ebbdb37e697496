"""Text search by blocks, and term counts within rows."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cvelake.plans import questions as qs
from cvelake.plans import search as se
from cvelake.session import stage


def _best(docs, queries, k):
    """Brute force: (query, rank, id, score); rows that share an id are one text."""
    def merged(rows):
        out = {}
        for i, text in rows:
            if i is not None:
                out[i] = out.get(i, Counter()) + Counter(re.findall("[a-z0-9_]+", (text or "").lower()))
        return out

    counts, asked = merged(docs), merged(queries)
    nameless = Counter(t for i, text in docs if i is None for t in (text or "").lower().split())
    df = Counter(t for c in [*counts.values(), nameless] for t in c)
    idf = {t: math.log((len(docs) + 1) / (n + 1)) for t, n in df.items()}

    def unit(c):
        v = {t: n * idf[t] for t, n in c.items() if idf.get(t, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    vectors, want = {i: unit(c) for i, c in counts.items()}, []
    for q, c in asked.items():
        v = unit(c)
        found = sorted((-round(s, 9), i) for i, d in vectors.items() if (s := sum(x * d.get(t, 0) for t, x in v.items())) > 0)
        want += [(q, r, i, round(-s, 6)) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(want)


@pytest.mark.parametrize("share", [0.0, 0.01, 2.0])  # all terms common, as it is, none common
@pytest.mark.parametrize("few", [0, 10_000])
def test_blocks_and_postings_equal_brute_force(spark, monkeypatch, share, few):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(3, 50)))) for i in range(250)]
    docs += [(250 + i, "w7 w8 w200") for i in range(40)] + [(3, "w1 w250 again"), (None, "w9 w260"), (900, None), (901, "")]
    asked = [(i, " ".join(rng.choices(words, weights, k=10)).upper()) for i in range(60)]
    asked += [(60, "w7 w200"), (61, "unknown"), (5, "w33 w34"), (None, "w7"), (62, None)]
    for name, value in {"FEW_QUERIES": few, "ASKED_BLOCK": 16, "DOCUMENT_BLOCK": 64, "COMMON_SHARE": share, "COMMON_TERMS": 7, "PAIRS": 50}.items():
        monkeypatch.setattr(se, name, value)
    got = se.tfidf_search(spark.createDataFrame(docs, "id long, t string"), "id", "t", spark.createDataFrame(asked, "q long, t string"), "q", "t", 5)
    assert sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in got.collect()) == _best(docs, asked, 5)


def test_many_queries_make_no_row_for_a_pair_of_query_and_document(spark):
    docs = spark.range(300).selectExpr("id", "concat('common shared words w', id) t")
    few = se.tfidf_search(docs, "id", "t", docs, "id", "t", 3)
    many = se.tfidf_search(docs, "id", "t", spark.range(se.FEW_QUERIES + 1).selectExpr("id q", "concat('common shared words w', id % 300) t"), "q", "t", 3)
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (few, many)]
    assert "cogroupsinarrow" in plans[1].lower() and "cogroupsinarrow" not in plans[0].lower()


def test_terms_are_counted_without_a_shuffle_of_words(spark):
    rows = [(1, "A a b_1"), (2, "Ünder x-y"), (None, None)]
    counts, n = se._counted(spark.createDataFrame(rows, "id long, t string"), "id", "t", "counted")
    assert n == 3
    got = {r["_id"]: dict(zip(r["terms"], r["tfs"], strict=True)) for r in counts.collect()}
    assert got == {1: {"a": 2, "b_1": 1}, 2: {"nder": 1, "x": 1, "y": 1}, None: {}}


def test_many_queries_in_rounds_equal_brute_force(spark, monkeypatch):
    """Copies tie, within a block of documents and across blocks: the smaller id wins."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(3, 40)))) for i in range(300)]
    docs += [(1000 - i, "w7 w8 w150") for i in range(200)] + [(3, "w1 w150 again"), (None, "w9"), (2000, None)]
    asked = [(f"q{i}", " ".join(rng.choices(words, weights, k=8))) for i in range(90)]
    asked += [("same", "w7 w150"), ("none", "unknown"), (None, "w7"), ("q5", "w33"), ("null", None)]
    for name, value in {"FEW_QUERIES": 0, "MANY_QUERIES": 0, "ROUND_QUERIES": 20, "SCORED_ROWS": 6, "SCORED_DOCUMENTS": 64, "BLOCK_POSTINGS": 500,
                        "COMMON_TERMS": 9, "PAIRS": 50}.items():
        monkeypatch.setattr(se, name, value)
    got = se.tfidf_search(spark.createDataFrame(docs, "id long, t string").repartition(5), "id", "t", spark.createDataFrame(asked, "q string, t string"), "q", "t", 5)
    got, want = sorted(map(tuple, got.collect())), _best(docs, asked, 5)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


def test_documents_are_not_copied_for_many_queries(spark, monkeypatch):
    """Rows that a search by rounds shuffles: its best only, whatever the number of queries."""
    monkeypatch.setattr(se, "ROUND_QUERIES", 1000)
    docs = spark.range(2000).selectExpr("id", "concat('common shared words w', id % 500) t")
    asked = spark.range(se.MANY_QUERIES + 1).selectExpr("id q", "concat('common shared words w', id % 500) t")
    plans = []
    monkeypatch.setattr(se, "stage", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or stage(df, name))
    assert se.tfidf_search(docs, "id", "t", asked, "q", "t", 3).filter("rank = 1").count() == se.MANY_QUERIES + 1
    rounds = [p for name, p in plans if name == "tfidf-round"]
    assert len(rounds) == 5
    for p in rounds:
        assert "CoGroup" not in p and p.count("Exchange") == 1 and p.index("WindowGroupLimit") < p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_shuffle_files_of_a_written_step_are_dropped(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    held = set(folder.rglob("shuffle_*"))
    out = stage(spark.range(20_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert out.count() == 7
    assert len([f for f in set(folder.rglob("shuffle_*")) - held if f.stat().st_size > 20_000]) == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_only_runs_that_may_be_vendors_are_dealt(spark):
    """Words are dealt to the join with the vendors' first words, not every run of words."""
    vendors = spark.createDataFrame([("Big_Corp",), ("acme",), (None,)], "vendor string")
    rows = [(1, "a big corp, and the big one"), (2, "corp big"), (3, None), (None, "acme"), (2, "acme Big-Corp")]
    parsed = qs.classify_questions(spark.createDataFrame(rows, "question_id long, raw_query string"), vendors, "2024-03-01")
    assert sorted((r["question_id"] or 0, r["vendors"]) for r in parsed.collect()) == [
        (0, []), (1, ["big_corp"]), (2, ["acme", "big_corp"]), (2, ["acme", "big_corp"]), (3, [])]
    lines = parsed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    runs = next(i for i, line in enumerate(lines) if "slice(" in line and "Generate" in line)
    assert runs < next(i for i, line in enumerate(lines) if "LeftSemi" in line)

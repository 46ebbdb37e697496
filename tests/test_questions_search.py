"""Routing examples from the docs, change feeds, vector and text search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cvelake.operators.changes import apply_changes, snapshot_diff
from cvelake.operators.vector import batch_cosine_topk, cosine_topk
from cvelake.plans import questions as qs
from cvelake.plans import search as se


def test_routing_examples(spark):
    qdf = spark.createDataFrame([
        (1, "What is CVE-2024-3094?"),
        (2, "Compare CVE-X and CVE-Y"),
        (3, "Critical vulns in Apache"),
        (4, "authentication bypass"),
        (5, "What's exploited this month?"),
        (6, "   "),
        (7, "cve-2024-1 and CVE-2024-2 please"),
        (8, "KEV entries since 2024-01-20"),
        (9, "high risk issues in the last 7 days"),
    ], "question_id long, raw_query string")
    vendors = spark.createDataFrame([("apache",), ("microsoft",)], "vendor string")
    p = {r["question_id"]: r for r in qs.classify_questions(qdf, vendors, "2024-03-01").collect()}
    assert p[1]["intent"] == "CVE_LOOKUP" and p[1]["cve_ids"] == ["CVE-2024-3094"]
    assert p[2]["intent"] == "COMPARISON"
    assert p[3]["intent"] == "FILTERED_SEARCH" and p[3]["vendors"] == ["apache"] and p[3]["risk_tiers"] == ["CRITICAL"]
    assert p[4]["intent"] == "SEMANTIC_SEARCH" and p[4]["search_text"] == "authentication bypass"
    assert p[5]["intent"] == "TREND_ANALYSIS" and str(p[5]["date_from"]) == "2024-01-31"
    assert p[6]["intent"] == "UNKNOWN"
    assert p[7]["intent"] == "COMPARISON" and p[7]["cve_ids"] == ["CVE-2024-1", "CVE-2024-2"]
    assert p[8]["intent"] == "FILTERED_SEARCH" and p[8]["kev_only"] and str(p[8]["date_from"]) == "2024-01-20"
    assert p[9]["intent"] == "FILTERED_SEARCH" and str(p[9]["date_from"]) == "2024-02-23"


def test_snapshot_diff_and_sync(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (3, None)], "k int, v string")
    ch = {(r["k"], r["_change_type"]): r["v"] for r in snapshot_diff(old, new, ["k"]).collect()}
    assert ch == {(2, "update_preimage"): "b", (2, "update_postimage"): "B", (4, "insert"): "d"}
    ch2 = snapshot_diff(new, old, ["k"])
    assert {(r["k"], r["_change_type"]) for r in ch2.collect()} >= {(4, "delete")}
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, e int")
    recomputed = spark.createDataFrame([(1, 10), (2, 21), (3, 30), (4, 40)], "k int, e int")
    synced = {r["k"]: r["e"] for r in apply_changes(target, snapshot_diff(old, new, ["k"]), ["k"], recomputed).collect()}
    assert synced == {1: 10, 2: 21, 3: 30, 4: 40}


def _brute(x, q, k):
    s = x @ q / (np.linalg.norm(x, axis=1) * np.linalg.norm(q))
    order = sorted(range(len(s)), key=lambda i: (-round(s[i], 9), i))
    return order[:k]


def test_vector_topk_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[5] = x[6]  # an exact tie
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(300)], "id int, embedding array<float>")
    q = x[0].astype(np.float64)
    got = [r["id"] for r in cosine_topk(df, "embedding", q.tolist(), 10, "id").orderBy("rank").collect()]
    assert got == _brute(x.astype(np.float64), q, 10)
    qdf = spark.createDataFrame([(j, x[j].tolist()) for j in (0, 5, 7)], "qid int, embedding array<float>")
    b = batch_cosine_topk(df.repartition(4), "embedding", "id", qdf, "qid", "embedding", 5).collect()
    for j in (0, 5, 7):
        ids = [r["id"] for r in sorted((r for r in b if r["query_id"] == j), key=lambda r: r["rank"])]
        assert ids == _brute(x.astype(np.float64), x[j].astype(np.float64), 5)


def test_tfidf_matches_brute_force(spark):
    import math
    import re
    from collections import Counter

    docs = ["the cat sat on the mat", "dogs and cats", "the stock market fell", "cat food market", "zebra"]
    queries = ["cat market", "the dogs"]
    ddf = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    qdf = spark.createDataFrame(list(enumerate(queries)), "qid long, text string")
    got = se.tfidf_search(ddf, "id", "text", qdf, "qid", "text", 3).collect()

    toks = [re.findall(r"[a-z0-9_]+", d.lower()) for d in docs]
    df_ = Counter(t for ts in toks for t in set(ts))
    idf = {t: math.log((len(docs) + 1) / (c + 1)) for t, c in df_.items()}

    def vec(ts):
        w = {t: c * idf[t] for t, c in Counter(ts).items() if idf.get(t, 0) > 0}
        n = math.sqrt(sum(v * v for v in w.values())) or 1
        return {t: v / n for t, v in w.items()}

    dv = [vec(ts) for ts in toks]
    for qi, qtext in enumerate(queries):
        qv = vec([t for t in re.findall(r"[a-z0-9_]+", qtext.lower()) if t in idf])
        sc = [(i, sum(qv.get(t, 0) * w for t, w in d.items())) for i, d in enumerate(dv)]
        sc = [(i, s) for i, s in sc if any(t in dv[i] for t in qv)]
        want = [i for i, _ in sorted(sc, key=lambda p: (-round(p[1], 9), p[0]))[:3]]
        mine = [r["id"] for r in sorted((r for r in got if r["query_id"] == qi), key=lambda r: r["rank"])]
        assert mine == want
        for r in got:
            if r["query_id"] == qi:
                assert r["score"] == pytest.approx(dict(sc)[r["id"]], abs=1e-6)


def test_semantic_search_prefilters(spark):
    rows = [
        ("C1", [1.0, 0.0], 9.8, "CRITICAL", 0.9, True, "acme | globex", "rocket", "CWE-79"),
        ("C2", [0.9, 0.1], 5.0, "MEDIUM", 0.1, False, "acme", "anvil", "CWE-20"),
        ("C3", [0.0, 1.0], 7.5, "HIGH", 0.5, True, "initech", "", None),
    ]
    f = spark.createDataFrame(rows, "cve_id string, embedding array<float>, cvss_v3_score double, "
                              "cvss_v3_severity string, epss_score double, kev_flag boolean, vendors_str string, "
                              "products_str string, cwe_id string")
    vectors, documents = f.select("cve_id", "embedding"), f.drop("embedding").withColumn("document_text", F.lit("anvil text"))
    gold = f.select("cve_id", "kev_flag", "cvss_v3_score").withColumns(
        {"description": F.lit("d"), "risk_tier": F.lit("HIGH"), "risk_score": F.col("cvss_v3_score") * 10})

    def ids(**kw):
        return [r["cve_id"] for r in se.semantic_search(vectors, documents, gold, [1.0, 0.0], 10, **kw).orderBy("rank").collect()]

    assert ids() == ["C1", "C2", "C3"]
    assert ids(kev_only=True) == ["C1", "C3"]
    assert ids(min_cvss=7.0, severities=["high"]) == ["C3"]
    assert ids(vendors=["ACME"]) == ["C1", "C2"]
    assert ids(products=["anvil"], min_epss=0.05) == ["C2"]
    assert ids(cwes=["cwe-79"]) == ["C1"]
    # Without vectors the keyword search answers, in the same form.
    found = se.search_or_fallback(vectors.filter("false"), documents, gold, [1.0, 0.0], "ANVIL", 10, min_cvss=7.0)
    assert [(r["cve_id"], r["score"], r["risk_tier"]) for r in found.orderBy("rank").collect()] == [("C1", None, "HIGH"), ("C3", None, "HIGH")]
    queries = spark.createDataFrame([(1, "anvil"), (2, "zebra")], "qid int, q string")
    hits = se.text_search(documents.withColumn("document_text", F.concat("cve_id", F.lit(" "), "products_str")), gold, queries, "qid", "q", 5, kev_only=False)
    assert [(r["query_id"], r["cve_id"], r["risk_tier"]) for r in hits.collect()] == [(1, "C2", "HIGH")]


def test_batch_search_in_blocks_keeps_vectors_off_the_driver(spark, monkeypatch):
    import cvelake.operators.vector as vec

    rng = np.random.default_rng(11)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(200)] + [(900, None)], "id int, embedding array<float>")
    qdf = spark.createDataFrame([(j, x[j].tolist()) for j in range(12)] + [(99, None)], "qid int, embedding array<float>")
    monkeypatch.setattr(vec, "QUERY_BLOCK", 5)
    monkeypatch.setattr(vec, "CANDIDATE_BLOCK", 60)
    plan = batch_cosine_topk(df.repartition(3), "embedding", "id", qdf, "qid", "embedding", 4)
    assert "_query" not in str(plan.schema)  # lazy: nothing was collected to build it
    b = plan.collect()
    assert {r["query_id"] for r in b} == set(range(12))
    for j in range(12):
        ids = [r["id"] for r in sorted((r for r in b if r["query_id"] == j), key=lambda r: r["rank"])]
        assert ids == _brute(x.astype(np.float64), x[j].astype(np.float64), 4)
    assert batch_cosine_topk(df, "embedding", "id", qdf.filter("false"), "qid", "embedding", 4).count() == 0


def test_vendors_of_several_words_and_far_dates(spark):
    qdf = spark.createDataFrame([
        (1, "Latest in Hewlett-Packard"), (2, "high vulns of Palo Alto Networks, Inc."), (3, "palo alto high"),
        (4, "new in the last 99999999999 days"), (5, "apache_tomcat high"), (6, None),
    ], "question_id long, raw_query string")
    vendors = spark.createDataFrame([("hewlett-packard",), ("palo_alto_networks",), ("Apache.Tomcat",), ("-",), (None,)], "vendor string")
    p = {r["question_id"]: r for r in qs.classify_questions(qdf, vendors, "2024-03-01").collect()}
    assert [p[i]["vendors"] for i in range(1, 7)] == [["hewlett-packard"], ["palo_alto_networks"], [], [], ["apache.tomcat"], []]
    assert str(p[4]["date_from"]) == "0003-07-12" or p[4]["date_from"].year < 100


def test_trends_honour_filters(spark):
    gold = spark.createDataFrame(
        [("C%d" % i, True, f"2024-02-{i:02d}", 50.0, "HIGH" if i % 2 else "LOW") for i in range(1, 21)] + [("C99", False, None, 1.0, "LOW")],
        "cve_id string, kev_flag boolean, d string, risk_score double, risk_tier string").withColumn("kev_date_added", F.to_date("d"))
    products = spark.createDataFrame([("C%d" % i, "Acme" if i % 3 else "Globex") for i in range(1, 21)] + [("C3", "acme"), ("C4", None)], "cve_id string, vendor string")
    qdf = spark.createDataFrame([
        (1, "TREND_ANALYSIS", [], [], None), (2, "TREND_ANALYSIS", ["globex"], ["HIGH"], "2024-02-05"),
        (3, "TREND_ANALYSIS", ["acme", "globex"], [], "2024-02-19"), (4, "CVE_LOOKUP", [], [], None),
    ], "question_id long, intent string, vendors array<string>, risk_tiers array<string>, d string").withColumn("date_from", F.to_date("d"))
    rows = qs.answer_trends(qdf, gold, products, 3, "2024-03-01").orderBy("question_id", "rank").collect()
    assert [(r["question_id"], r["cve_id"]) for r in rows] == [(1, "C20"), (1, "C19"), (1, "C18"), (2, "C15"), (2, "C9"), (3, "C20"), (3, "C19")]
    counts = qs.answer_trend_vendors(qdf, gold, products, 2, "2024-03-01").orderBy("question_id", "rank").collect()
    assert [(r["question_id"], r["vendor"], r["kev_count"]) for r in counts] == [(1, "acme", 15), (1, "globex", 6), (2, "globex", 2), (3, "acme", 2)]


def test_pruned_postings_give_the_same_answers(spark):
    """All pairs in plain Python; common words' postings are mostly left alone."""
    import math
    import random
    from collections import Counter

    from cvelake.plans import search as se

    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(5, 60))) for _ in range(600)] + ["w0 w1", "", "w399"]
    asked = [" ".join(rng.choices(words, weights, k=12)) + f" w{300 + i}" for i in range(25)] + ["w0", "unknown", "w0 w1 w2 w3"]
    tf = [Counter(t.split()) for t in texts]
    df = Counter(w for t in tf for w in t)
    idf = {w: math.log((len(texts) + 1) / (n + 1)) for w, n in df.items()}

    def unit(counts):
        v = {w: n * idf[w] for w, n in counts.items() if idf.get(w, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    docs = [unit(t) for t in tf]
    want = []
    for q, text in enumerate(asked):
        v = unit(Counter(text.split()))
        scored = sorted((-round(s, 9), i) for i, d in enumerate(docs) if (s := sum(x * d.get(w, 0) for w, x in v.items())))
        want += [(q, r, i, round(-s, 6)) for r, (s, i) in enumerate(scored[:5], 1)]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    a = spark.createDataFrame(list(enumerate(asked)), "q long, t string")
    for first in (1, 2_000):  # few or all first candidates
        se.FIRST_POSTINGS, before = first, se.FIRST_POSTINGS
        try:
            got = se.tfidf_search(d, "id", "t", a, "q", "t", 5).collect()
        finally:
            se.FIRST_POSTINGS = before
        assert sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in got) == sorted(want)
    postings = spark.createDataFrame([(i, w, x) for i, v in enumerate(docs) for w, x in v.items()], "_id long, term string, w double")
    facts = postings.groupBy("term").agg(F.max("w").alias("most"), F.count("*").alias("df"))
    qn = spark.createDataFrame([(q, w, x) for q, t in enumerate(asked) for w, x in unit(Counter(t.split())).items()], "query_id long, term string, qw double")
    terms = qn.join(facts, "term").withColumn("bound", F.col("qw") * F.col("most")).drop("most")
    needed, spare = se.needed_terms(terms, postings, 5)
    assert needed.agg(F.sum("df")).first()[0] < 0.6 * terms.agg(F.sum("df")).first()[0] and spare.count() > 0

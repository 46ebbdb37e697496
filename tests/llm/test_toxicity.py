"""The n-gram classifier: parts against plain versions, held-out accuracy, odd rows."""

import numpy as np
from helpers_llm import SF
from pyspark.sql import functions as F

from cvelake.llm import queries, toxicity

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"
BAD = ["zorgul", "vextrim", "plunkad"]


def corpus(n, seed=0):
    """Random syllables; every third text holds a word of BAD."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(["ta", "ri", "mo", "ne", "su", "la"], 3)) for _ in range(rng.integers(3, 60))]
        toxic = int(i % 3 == 0)
        if toxic:
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(BAD)).title())
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_hashes_are_those_of_all_grams():
    def grams(text):
        t = f" {text.lower()} "
        return {t[i : i + n] for n in range(3, 6) for i in range(len(t) - n + 1)}

    texts = ["", "a", "Grüße, 日本!", "aXbxab" * 20]
    every = set().union(*map(grams, texts))
    known = {g: int(h) for g in every for h in [_hash(g)]}
    assert len(set(known.values())) == len(every)
    for t in texts:
        assert set(toxicity.distinct(t).tolist()) == {known[g] for g in grams(t)}


def _hash(gram):
    total = ord(gram[0])
    for c in gram[1:]:
        total = (total * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
    return (total ^ (total >> 32)) * 0xD6E8FEB86659FD93 % 2**64


def test_stretches_of_a_long_text_lose_no_gram(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    whole = toxicity.distinct(text)
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    assert toxicity.distinct(text).tolist() == whole.tolist()


def test_regression_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(40)]
    labels, ratios = rng.integers(0, 2, 40).astype(float), rng.normal(size=6)
    w, bias = toxicity.regression(rows, labels, ratios, penalty=0.1, steps=4000, rate=0.01)

    def loss(w, bias):
        z = np.array([(w * ratios)[r].sum() for r in rows]) + bias
        return np.log1p(np.exp(-np.where(labels == 1, z, -z))).mean() + 0.05 * (w**2).sum()

    best = loss(w, bias)
    for j in range(6):
        for d in (-0.01, 0.01):
            moved = w.copy()
            moved[j] += d
            assert loss(moved, bias) > best
    assert loss(w, bias + 0.01) > best and loss(w, bias - 0.01) > best


def test_counts_and_ratios_equal_plain_counts(spark):
    rows, labels = corpus(60)
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    learned = {r["doc_id"] for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    model = toxicity.fit(docs, marks)
    counts = {}
    for (i, text), (_, toxic) in zip(rows, labels, strict=True):
        for h in toxicity.distinct(text).tolist() if i in learned else []:
            counts.setdefault(h, [0, 0])[toxic] += 1
    assert set(model.keys.tolist()) == {h for h, c in counts.items() if sum(c) >= toxicity.SUPPORT}


def test_held_out_rows_are_found_and_teach_nothing(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame(rows, DOCS)
    truth = dict(labels)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    found, score = toxicity.score(docs.withColumn("held", toxicity.held_out(F.col("doc_id"))), model)
    held = [r for r in found.collect() if r["held"]]
    assert 80 < len(held) < 160
    assert np.mean([(r[score] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held]) > 0.97
    # Other labels on held-out rows change nothing.
    ids = {r["doc_id"] for r in held}
    other = toxicity.fit(docs, spark.createDataFrame([(i, 1 - t if i in ids else t) for i, t in labels], LABELS))
    assert other.keys.tolist() == model.keys.tolist() and np.allclose(other.weights, model.weights) and np.isclose(other.bias, model.bias)


def test_the_sample_is_bounded_and_the_share_of_labels_stays(spark):
    rows, labels = corpus(600)
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    chosen, totals = toxicity.sample(docs, marks, docs_per_class=50)
    assert sorted(r["count"] for r in chosen.groupBy("toxic").count().collect()) == [50, 50]
    assert totals[0] > 1.5 * totals[1]
    found, score = toxicity.score(docs, toxicity.fit(docs, marks, docs_per_class=50))
    truth = dict(labels)
    assert np.mean([(r[score] >= 0.5) == (truth[r["doc_id"]] == 1) for r in found.collect()]) > 0.97


def test_nulls_empty_and_long_texts_repeated_rows_and_labels(spark):
    rows, labels = corpus(300)
    rows += [(1000, None), (1001, ""), (None, "zorgul"), (None, None), (1002, "ta ri " * 300_000 + "Vextrim"), (0, rows[0][1]), (0, "other")]
    labels += [(None, 1), (5, None), (6, 7), (3, 0), (3, 1), (3, 1), (9999, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(None).cast("string") for c in ("toxicity", "toxic", "Score")})
    found, score = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(labels, LABELS)))
    out = found.collect()
    assert len(out) == len(rows) and all(0 <= r[score] <= 1 for r in out)
    assert found.columns[:-1] == docs.columns
    by_id = {r["doc_id"]: r[score] for r in out}
    assert by_id[1000] == by_id[1001]
    assert by_id[1002] > 0.5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    for labels, share in (([], 0.0), ([(1, 0)], 0.0), ([(2, 1)], 1.0), ([(9, 1), (8, 0)], 0.0)):
        labels = spark.createDataFrame(labels, LABELS)
        found, score = toxicity.score(docs, toxicity.fit(docs, labels))
        assert [r[score] for r in found.collect()] == [share, share]
    none = spark.createDataFrame([], DOCS)
    assert toxicity.score(none, toxicity.fit(none, labels))[0].collect() == []


def test_query_separates_the_labels_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.op12_naive_bayes_toxicity(spark, sf).collect()
    assert len(found) == 1000 and {r["predicted"] for r in found} == {0, 1}
    seen = [r for r in found if r["doc_id"] in truth]
    good = [(a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in seen if truth[a["doc_id"]] for b in seen if not truth[b["doc_id"]] and a["held_out"] and b["held_out"]]
    assert np.mean(good) > 0.9
    assert len(queries.op12_naive_bayes_toxicity(spark, SF).collect()) == spark.read.parquet(f"{SF}/documents.parquet").count()
